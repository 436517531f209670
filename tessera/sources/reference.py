"""Literal reference dimensions.

These are fixed-size (7, 7 and 8 rows) so broadcasting them is safe at any
data scale.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: must equal the reference's seeded rows -------------------
# Acquisition channels: (key, name, category, CAC low, CAC high, description)
ACQUISITION_CHANNELS = [
    (1, "Organic Search", "Organic", 0, 5, "Unpaid search engine results"),
    (2, "Paid Search", "Paid", 25, 40, "Sponsored search advertising"),
    (3, "Social Media", "Paid", 15, 35, "Paid social media campaigns"),
    (4, "Email Marketing", "Organic", 5, 12, "Owned email newsletters and campaigns"),
    (5, "Direct", "Direct", 0, 0, "Typed URL or bookmark"),
    (6, "Referral", "Organic", 10, 25, "Referral and word-of-mouth programmes"),
    (7, "Affiliate", "Paid", 8, 18, "Commission-based affiliate partners"),
]

# Payment methods: (key, name, category, IsDigital, description)
PAYMENT_METHODS = [
    (1, "Credit Card", "Card", True, "Visa, Mastercard, Amex"),
    (2, "Debit Card", "Card", True, "Bank debit cards"),
    (3, "PayPal", "Digital", True, "PayPal wallet"),
    (4, "Bank Transfer", "Traditional", False, "Direct bank transfer"),
    (5, "Cash on Delivery", "Traditional", False, "Cash paid to the courier"),
    (6, "Gift Card", "Prepaid", False, "Store gift cards"),
    (7, "Buy Now Pay Later", "BNPL", True, "Deferred instalment payment"),
]

# Return reasons: (key, code, name, category, IsOperationalFailure, AppliesTo, description)
RETURN_REASONS = [
    (1, "DEFECT", "Defective Product", "Product Quality", True, "Both", "Item faulty or broken"),
    (2, "WRONG", "Wrong Item Shipped", "Fulfilment Error", True, "Both", "Different item than ordered"),
    (3, "DAMAGED", "Arrived Damaged", "Packaging / Transit", True, "Both", "Damaged in transit"),
    (4, "MINDCHG", "Changed Mind", "Customer Preference", False, "Both", "Customer no longer wants it"),
    (5, "NOTDESC", "Not As Described", "Expectation Mismatch", False, "Both", "Differs from the listing"),
    (6, "LATE", "Late Delivery", "Fulfilment Error", True, "Online Only", "Arrived after the promised date"),
    (7, "PRICE", "Better Price Found", "Customer Preference", False, "Both", "Cheaper elsewhere"),
    (8, "DUPL", "Duplicate Order", "Customer Error", False, "Both", "Ordered twice by mistake"),
]
# -----------------------------------------------------------------------------


def acquisition_channels(spark: SparkSession) -> DataFrame:
    rows = [(k, n, c, Decimal(lo), Decimal(hi), d) for k, n, c, lo, hi, d in ACQUISITION_CHANNELS]
    df = spark.createDataFrame(
        rows,
        "AcquisitionChannelKey int, ChannelName string, ChannelCategory string, "
        "EstimatedCACLow decimal(19,4), EstimatedCACHigh decimal(19,4), ChannelDescription string",
    )
    return F.broadcast(df)


def payment_methods(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(
        PAYMENT_METHODS,
        "PaymentMethodKey int, PaymentMethodName string, PaymentCategory string, "
        "IsDigital boolean, PaymentDescription string",
    )
    return F.broadcast(df)


def return_reasons(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(
        RETURN_REASONS,
        "ReturnReasonKey int, ReturnReasonCode string, ReturnReasonName string, "
        "ReturnReasonCategory string, IsOperationalFailure boolean, AppliesTo string, "
        "ReturnReasonDescription string",
    )
    return F.broadcast(df)


def values_sql(rows, cols) -> str:
    """DuckDB VALUES text for a literal table (used by the oracle twins)."""

    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"
