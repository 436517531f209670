"""Reports over the literal reference dimensions only (Q1-Q8, Q60, Q61).

They read nothing but the 7/7/8-row seeded tables, so they are one small
job each and are exposed as library functions (tested in
``tests/test_operators.py``) rather than registered data queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans import dims

EXPECTED_ROWS = {"dim.vPaymentMethod": 7, "dim.vAcquisitionChannel": 7, "dim.vReturnReason": 8}  # fixed values


def _cnt():
    return F.count(F.lit(1))


def _listagg(col: str) -> F.Column:
    """STRING_AGG with a deterministic order (the reference leaves it unordered)."""
    return F.array_join(F.sort_array(F.collect_list(col)), ", ")


def q1_reference_row_counts(m) -> DataFrame:
    parts = [(n, df) for n, df in [("gen.DimAcquisitionChannel", m.ref_acquisition_channel),
                                   ("gen.DimPaymentMethod", m.ref_payment_method),
                                   ("gen.DimReturnReason", m.ref_return_reason)]]
    out = None
    for n, df in parts:
        p = df.agg(_cnt().alias("TotalRows")).select(F.lit(n).alias("TableName"), "TotalRows")
        out = p if out is None else out.unionByName(p)
    return out


def q2_channels(m) -> DataFrame:
    c = m.ref_acquisition_channel
    return c.select("AcquisitionChannelKey", "ChannelName", "ChannelCategory", "EstimatedCACLow", "EstimatedCACHigh",
                    ((F.col("EstimatedCACLow") + F.col("EstimatedCACHigh")) / 2).cast("decimal(19,4)")
                    .alias("CACMidpoint_Preview"),
                    (F.col("ChannelCategory") != "Paid").alias("IsOrganic_Preview"))


def q3_channel_categories(m) -> DataFrame:
    return m.ref_acquisition_channel.groupBy("ChannelCategory").agg(
        _cnt().alias("ChannelCount"), F.min("EstimatedCACLow").alias("MinCACLow"),
        F.max("EstimatedCACHigh").alias("MaxCACHigh"))


def q4_payment_types(m) -> DataFrame:
    p = m.ref_payment_method
    return p.select("PaymentMethodKey", "PaymentMethodName", "PaymentCategory", "IsDigital",
                    F.when(F.col("IsDigital"), "Digital").otherwise("Non-Digital").alias("PaymentType_Preview"))


def q5_payment_digital_groups(m) -> DataFrame:
    p = m.ref_payment_method
    return p.groupBy(F.when(F.col("IsDigital"), "Digital").otherwise("Non-Digital").alias("PaymentType")).agg(
        _cnt().alias("MethodCount"), _listagg("PaymentMethodName").alias("Methods"))


def q6_reasons(m) -> DataFrame:
    return m.ref_return_reason.select("ReturnReasonKey", "ReturnReasonCode", "ReturnReasonName",
                                      "ReturnReasonCategory", "IsOperationalFailure", "AppliesTo")


def _accountability(df: DataFrame) -> DataFrame:
    return df.groupBy(F.when(F.col("IsOperationalFailure"), "Operational Failure").otherwise("Customer-Led")
                      .alias("AccountabilityType")).agg(_cnt().alias("ReasonCount"),
                                                        _listagg("ReturnReasonCode").alias("ReasonCodes"))


def q7_reasons_by_accountability(m) -> DataFrame:
    return _accountability(m.ref_return_reason)


def q8_reasons_by_scope(m) -> DataFrame:
    return m.ref_return_reason.groupBy("AppliesTo").agg(_cnt().alias("ReasonCount"),
                                                        _listagg("ReturnReasonName").alias("Reasons"))


def q60_reference_counts_pass_fail(m) -> DataFrame:
    out = None
    for name, fn in [("dim.vPaymentMethod", dims.v_payment_method),
                     ("dim.vAcquisitionChannel", dims.v_acquisition_channel),
                     ("dim.vReturnReason", dims.v_return_reason)]:
        exp = EXPECTED_ROWS[name]
        p = m.get(fn).agg(_cnt().alias("ActualRows")).select(
            F.lit(name).alias("ViewName"), "ActualRows", F.lit(exp).alias("ExpectedRows"),
            F.when(F.col("ActualRows") == exp, "✓ PASS").otherwise("✗ FAIL").alias("Result"))
        out = p if out is None else out.unionByName(p)
    return out


def q61_reason_view_by_accountability(m) -> DataFrame:
    return _accountability(m.get(dims.v_return_reason))
