"""Operators and edge cases on hand-made frames, checked against brute force."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import pad, shift, us_week
from tessera.mart import Mart
from tessera.operators import argmax_key, metric_rows, with_row_number
from tessera.plans import checks_fulfilment, checks_marts, gen, reference_reports
from tests.conftest import SF_SMALL


def inject(m, fn, df):
    m.__dict__.setdefault("_memo", {})[fn.__module__ + "." + fn.__name__] = df


IDS = [f"{c}-{k}" for c in "AB" for k in [*range(1, 3000, 7), *range(10**9, 10**9 + 500), *(10**12 * o + n for o in (1, 12, 120, 1200, 99) for n in range(1, 40))]]


@pytest.mark.parametrize("steps", [(8, 22), (7, 12, 17, 22), (1, 2, 3), (30,)])
def test_row_number_matches_brute_force(spark, steps):
    """Ids of many lengths, common prefixes and prefixes of each other."""
    ids = [*IDS, "A-", "B-1 ", "Bé"]
    df = spark.createDataFrame([(i[0], i, n) for n, i in enumerate(ids)], "g string, i string, n long").repartition(7)
    got = with_row_number(df, "g", "i", "rn", steps).collect()
    want = {i: n for n, i in enumerate(sorted(ids, key=lambda i: (i[0], i.encode())), 1)}
    assert {r["i"]: r["rn"] for r in got} == want and {r["i"]: r["n"] for r in got} == {i: n for n, i in enumerate(ids)}
    assert with_row_number(df.limit(0), "g", "i", "rn", steps).count() == 0


def test_row_number_runs_no_job_and_repeats(spark):
    df = spark.createDataFrame([(i[0], i) for i in IDS], "g string, i string").repartition(5)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("row-number", "")
    try:
        out = with_row_number(df, "g", "i", "rn")
        assert not tracker.getJobIdsForGroup("row-number")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert out.exceptAll(with_row_number(df.repartition(3), "g", "i", "rn")).count() == 0


def test_ratio_rounds_ties_exactly(spark):
    """Ties half away from zero, signs, zero divisors, large values; both twins."""
    import duckdb

    from tessera.functions import ratio
    from tessera.oracle.adapter_sql import ratio as sratio

    rows = [("23.2477", 2), ("-23.2477", 2), ("0.0001", 2), ("0.0001", 3), ("0.0002", 3), ("1.0000", 0), ("0.0000", 7), ("1", None), (None, 3),
            ("99999999999999.9999", 7), ("23.2477", -2), ("0.0003", 20000)]
    df = spark.createDataFrame([(None if a is None else Decimal(a), b) for a, b in rows], "a decimal(19,4), b long")
    got = df.select(ratio("a", "b", 4, scale=4).alias("x"), ratio("b", "a", 4, 38, den_scale=4).alias("y")).collect()

    def half_up(x, y):
        return None if x is None or not y else (Decimal(x) / Decimal(y)).quantize(Decimal("0.0001"), rounding="ROUND_HALF_UP")

    assert [r["x"] for r in got] == [half_up(a, b) for a, b in rows]
    assert [r["y"] for r in got] == [half_up(b, None if a is None else Decimal(a)) for a, b in rows]
    assert str(got[0]["x"]) == "11.6239"
    body = ", ".join(f"({'NULL' if a is None else a}::DECIMAL(19,4), {'NULL' if b is None else b}::BIGINT)" for a, b in rows)
    duck = duckdb.sql(f"SELECT {sratio('a', 'b', 4, scale=4)} AS x, {sratio('b', 'a', 4, 38, den_scale=4)} AS y FROM (VALUES {body}) t(a, b)").fetchall()
    assert duck == [(r["x"], r["y"]) for r in got]


def test_distinct_counts_by_bits(spark):
    """Dense, sparse, negative, null and repeated keys; pairs; conditions."""
    from tessera.operators import distinct_counts

    rows = [(k, k % 3, k % 5) for k in [*range(-200, 200), *range(-200, 50), *range(10**15, 10**17, 10**15), 2**62, -(2**62)]] + [(None, 1, 1), (5, None, 1)] + [(7, 1, 2)] * 500
    df = spark.createDataFrame(rows, "k long, b int, c int").repartition(6)
    got = distinct_counts(df, F.col("k"), {"all": None, "some": F.col("c") == 2, "none": F.lit(False)}, {"n": F.count(F.lit(1)), "twos": F.count_if(F.col("c") == 2)}).first()
    keys = {k for k, _, _ in rows if k is not None}
    assert tuple(got) == (len(keys), len({k for k, _, c in rows if c == 2}), 0, len(rows), sum(c == 2 for _, _, c in rows))
    pairs = distinct_counts(df, F.col("k"), {"p": None}, by=[F.col("b")])
    assert pairs.first()["p"] == len({(k, b) for k, b, _ in rows if k is not None and b is not None})
    assert tuple(distinct_counts(df.limit(0), F.col("k"), {"a": None}, {"n": F.count(F.lit(1))}).first()) == (0, 0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan and "SortAggregate" not in plan


def test_listagg_with_a_hot_group(spark):
    from tessera.operators import ordered_listagg

    rows = [("hot", i * 7919 % 10007, f"v{i % 3}") for i in range(3000)] + [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("n", 1, None), (None, 1, "z"), ("a", 3, None)]
    df = spark.createDataFrame(rows, "g string, o int, v string").repartition(6)
    got = {r["g"]: r["t"] for r in ordered_listagg(df, ["g"], "v", ["o"], "t", sep="|", salts=8).collect()}
    groups = {}
    for g, o, v in rows:
        groups.setdefault(g, []).extend([(o, v)] if v is not None else [])
    assert got == {g: "|".join(v for _, v in sorted(vs)) for g, vs in groups.items()}


def test_forest_of_a_long_chain(spark):
    """Rounds by the logarithm of the depth; cycles and those under them are left out."""
    from tessera.operators import forest

    n = 10_000
    chain = spark.range(n).select((F.col("id") + 1).alias("k"), F.when(F.col("id") > 0, F.col("id")).alias("p"))
    extra = spark.createDataFrame([(20001, 20002), (20002, 20001), (20003, 20001), (30000, 99999), (30001, 30000), (30002, 30002)], "k long, p long")
    out, rounds = forest(chain.unionByName(extra), "k", "p")
    assert rounds <= 20
    depth = {r["k"]: (r["Depth"], r["n"], r["end"]) for r in out.select("k", "Depth", F.size(F.split("Path", "/")).alias("n"), F.right("Path", F.lit(11)).alias("end")).collect()}
    assert len(depth) == n + 2
    assert all(depth[k][:2] == (k - 1, k) for k in range(1, n + 1)) and depth[10_000][2] == "/9999/10000"
    assert depth[30000] == (0, 1, "30000") and depth[30001] == (1, 2, "30000/30001")


def test_argmax_ties_go_to_lowest_key(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 1.0, 3.0), (0.5, 0.5, 0.5)], "a double, b double, c double")
    out = df.select(argmax_key({1: F.col("a"), 2: F.col("b"), 3: F.col("c")}).alias("k")).collect()
    assert [r.k for r in out] == [2, 1, 1]


def test_metric_rows(spark):
    row = spark.range(1).select(F.lit(3).alias("x"), F.lit(0).alias("y"))
    out = {r.Metric: r.Value for r in metric_rows(row, [("x", F.col("x")), ("y", F.col("y"))]).collect()}
    assert out == {"x": 3, "y": 0}


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2022, 1, 1),), (dt.date(2022, 1, 2),),
                                (dt.date(2023, 12, 31),), (dt.date(2008, 2, 29),)], "d date")
    out = df.select(us_week("d").alias("w"), shift("d", 16).alias("s")).collect()
    assert [r.w for r in out] == [1, 1, 2, 53, 9]
    assert out[4].s == dt.date(2024, 2, 29)
    ages = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2001, 2, 28)), (dt.date(2000, 5, 1), dt.date(2010, 4, 30)),
                                  (dt.date(2000, 5, 1), dt.date(2010, 5, 1))], "b date, a date")
    assert [r.x for r in ages.select(gen._exact_age(F.col("b"), F.col("a")).alias("x")).collect()] == [1, 9, 10]


def test_fulfilment_tiers_at_the_cuts(spark):
    m = Mart(spark, SF_SMALL)
    rows = [("SO1", dt.date(2000, 1, 1), "Delivered", "Standard", 1, 2, 3),
            ("SO2", dt.date(2000, 1, 1), "Delivered", "Standard", 3, 4, 7),
            ("SO3", dt.date(2000, 1, 1), "Returned", "Standard", 4, 10, 14),
            ("SO4", dt.date(2000, 1, 1), "Delivered", "Standard", 5, 10, 15),
            ("SO5", dt.date(2000, 1, 1), "Shipped", "Express", 1, None, None),
            ("SO6", dt.date(2000, 1, 1), "Cancelled", "Express", None, None, None)]
    df = spark.createDataFrame(rows, "SalesOrderNumber string, OrderDate date, FulfillmentStatus string, "
                                     "ShippingMethod string, ProcessingDays int, TransitDays int, TotalFulfillmentDays int")
    df = df.withColumn("ShipDate", F.lit(None).cast("date")).withColumn("DeliveryDate", F.lit(None).cast("date"))
    inject(m, gen.gen_order_fulfillment, df)
    out = {r.SalesOrderNumber: r for r in m.get(checks_fulfilment.v_order_fulfillment).collect()}
    assert out["SO1"].FulfillmentTier.startswith("1") and out["SO1"].SLAStatus == "Express SLA Met"
    assert out["SO2"].FulfillmentTier.startswith("2") and out["SO2"].IsOnTime == 1
    assert out["SO3"].FulfillmentTier.startswith("3") and out["SO3"].SLAStatus == "In Progress"
    assert out["SO4"].FulfillmentTier.startswith("4") and out["SO4"].SLAStatus == "SLA Breached"
    assert out["SO5"].FulfillmentTier is None and out["SO6"].DelayRootCause is None
    assert out["SO3"].DelayRootCause == "Carrier Delay" and out["SO1"].DelayRootCause == "Balanced"
    assert out["SO2"].DelayRootCause == "Balanced"


def test_stock_status_at_the_cuts(spark):
    m = Mart(spark, SF_SMALL)
    rows = [(i, dt.datetime(2000, 1, 1), 1, 1, 1, oh, 0, ss, Decimal("1.0"), 1, 1, 1, None)
            for i, (oh, ss) in enumerate([(0, 10), (9, 10), (10, 10), (20, 10), (21, 10), (40, 10), (41, 10), (5, 0)])]
    df = spark.createDataFrame(rows, "InventoryKey long, DateKey timestamp, StoreKey int, ProductKey int, CurrencyKey int, "
                                     "OnHandQuantity int, OnOrderQuantity int, SafetyStockQuantity int, "
                                     "UnitCost decimal(19,4), DaysInStock int, MinDayInStock int, MaxDayInStock int, Aging int")
    m.__dict__["fact_inventory"] = df
    out = [r.StockStatus for r in m.get(checks_marts.v_inventory).orderBy("InventoryKey").collect()]
    assert out == ["Stock-Out", "Low Stock", "In Stock", "In Stock", "Overstocked", "Overstocked",
                   "Severely Overstocked", "Severely Overstocked"]


def test_return_tiers_and_exclusions(spark):
    m = Mart(spark, SF_SMALL)
    lines = spark.createDataFrame(
        [(1, dt.datetime(1996, 1, 1), 1, Decimal("49.9999")), (2, dt.datetime(1996, 1, 1), 1, Decimal("50")),
         (3, dt.datetime(1996, 1, 1), 1, Decimal("200")), (4, dt.datetime(1996, 1, 1), 2, Decimal("0")),
         (5, dt.datetime(2100, 1, 1), 1, Decimal("10"))],
        "k long, DateKey timestamp, ReturnQuantity int, ReturnAmount decimal(19,4)")
    out = {r.k: r for r in gen._returns(m, lines, ("k",), "t", gen.ONLINE_LAG, gen.ONLINE_REFUND_PCT,
                                       gen.ONLINE_REASON_SCOPE).collect()}
    assert set(out) == {1, 2, 3, 5}  # zero-amount return excluded
    assert out[1].tier == 1 and out[2].tier == 2 and out[3].tier == 3
    assert 7 <= out[1].ReturnLagDays <= 14 and 21 <= out[3].ReturnLagDays <= 45
    assert out[5].ReturnDate < dt.date(2100, 1, 1)  # clamped to the max date; the stored lag is not
    assert all((r.RefundAmount > 0) == r.IsRefunded for r in out.values())


def test_reference_reports(spark):
    m = Mart(spark, SF_SMALL)
    assert {r.TableName: r.TotalRows for r in reference_reports.q1_reference_row_counts(m).collect()} == {
        "gen.DimAcquisitionChannel": 7, "gen.DimPaymentMethod": 7, "gen.DimReturnReason": 8}
    assert all(r.Result == "✓ PASS" for r in reference_reports.q60_reference_counts_pass_fail(m).collect())
    acc = {r.AccountabilityType: (r.ReasonCount, r.ReasonCodes) for r in reference_reports.q7_reasons_by_accountability(m).collect()}
    assert acc["Operational Failure"] == (4, "DAMAGED, DEFECT, LATE, WRONG")
    assert acc == {r.AccountabilityType: (r.ReasonCount, r.ReasonCodes)
                   for r in reference_reports.q61_reason_view_by_accountability(m).collect()}
    scope = {r.AppliesTo: r.ReasonCount for r in reference_reports.q8_reasons_by_scope(m).collect()}
    assert scope == {"Both": 7, "Online Only": 1}
    dig = {r.PaymentType: r.MethodCount for r in reference_reports.q5_payment_digital_groups(m).collect()}
    assert dig == {"Digital": 4, "Non-Digital": 3}
    cats = {r.ChannelCategory: r.ChannelCount for r in reference_reports.q3_channel_categories(m).collect()}
    assert cats == {"Organic": 3, "Paid": 3, "Direct": 1}
    assert reference_reports.q2_channels(m).count() == 7 and reference_reports.q4_payment_types(m).count() == 7
    assert reference_reports.q6_reasons(m).count() == 8


NO_ORDERS = "OrderKey long, CustomerKey long"


def test_line_numbering_matches_per_order_window(spark):
    """Numbering in ranges of parts equals numbering each order's identities at
    once; lines that repeat an identity share its number; the key holds the pair."""
    from tessera.sources import adapter

    order = ["OrderKey", "_ln", "_pk", "_sk", "_sd", "_ep"]
    ids = adapter.line_identities(spark, SF_SMALL, "O")
    ids = ids.unionByName(ids.limit(50))
    orders = adapter.orders_of_lines(spark, SF_SMALL)
    got = adapter.line_numbers(ids, orders).select(*order, "LineNumber", adapter.line_key("K")).toPandas()
    got = got.sort_values(order).reset_index(drop=True)
    assert len(got) == ids.distinct().count() < ids.count()
    assert list(got["LineNumber"]) == list(got.groupby("OrderKey").cumcount() + 1)
    assert [int(k) for k in got["K"]] == [o * 10**12 + n for o, n in zip(got["OrderKey"], got["LineNumber"])]


def _lines(spark, n, order, parts):
    return spark.range(n).select(F.lit(order).cast("long").alias("OrderKey"), (F.col("id") % 5).alias("_ln"), (F.col("id") * parts).alias("_pk"),
                                 F.lit(1).alias("_sk"), F.lit(dt.datetime(2000, 1, 1)).alias("_sd"), F.lit(1.0).alias("_ep"))


def test_line_numbering_with_one_hot_order(spark):
    """One order holding most rows is numbered exactly, in many groups."""
    from tessera.sources import adapter

    n = 20000
    df = _lines(spark, n, 7, 3).unionByName(_lines(spark, 100, 8, 1)).repartition(8)
    out = adapter.line_numbers(df, spark.createDataFrame([(7, 1), (8, 2)], NO_ORDERS)).withColumn("K", adapter.line_key("K"))
    nums = {r["OrderKey"]: tuple(r)[1:] for r in out.groupBy("OrderKey").agg(
        F.min("LineNumber"), F.max("LineNumber"), F.countDistinct("LineNumber"), F.countDistinct("K")).collect()}
    assert nums == {7: (1, n, n, n), 8: (1, 100, 100, 100)}


def test_padding_never_shortens(spark):
    df = spark.createDataFrame([(7,), (123456,), (98765432101,)], "k long")
    assert [r.p for r in df.select(pad("k", 4).alias("p")).collect()] == ["0007", "123456", "98765432101"]


def test_a_new_line_moves_no_other_orders_returns(spark, tmp_path):
    """Draws and ids hang on the line's order and its number there."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    low = li.where("l_linestatus = 'O'").orderBy("l_orderkey", "l_linenumber").limit(1)
    first = low.first()["l_orderkey"]
    li.unionByName(low.withColumn("l_linenumber", F.lit(0).cast(li.schema["l_linenumber"].dataType))).write.parquet(str(tmp_path / "lineitem.parquet"))
    for t in ("orders", "customer", "part", "supplier", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    for fn in (gen.gen_online_returns, gen.gen_store_returns):
        before, after = fn(Mart(spark, SF_SMALL)), fn(Mart(spark, str(tmp_path)))
        key = before.columns[0]
        others = lambda d: {tuple(r) for r in d.where(F.expr(f"{key} div 1000000000000") != first).collect()}
        assert others(before) and others(before) == others(after), fn.__name__


def test_keys_of_twelve_digits(spark, tmp_path):
    """Order, customer, product, store and employee keys beyond 32 bits and the
    old widths: order numbers stay unique and every pipeline runs."""
    from tessera.plans.registry import REGISTRY

    far = 123_456_000_000
    shift_keys = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "orders": ["o_orderkey", "o_custkey"], "customer": ["c_custkey"],
                  "part": ["p_partkey"], "supplier": ["s_suppkey"], "nation": [], "region": []}
    for t, keys in shift_keys.items():
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        df.withColumns({k: F.col(k).cast("long") + far for k in keys}).write.parquet(str(tmp_path / f"{t}.parquet"))
    m = Mart(spark, str(tmp_path))
    near = Mart(spark, SF_SMALL)
    for name in ("P1_customer_acquisition", "P2_order_payment", "P3_order_fulfillment", "P4_marketing_spend", "P5_customer_survey",
                 "P6_online_returns", "P7_store_returns", "V12_online_sales", "V14_returns", "V15_inventory", "M9_payment_by_region",
                 "M10_payment_return_cancel_rates", "M11_on_time_by_method_region"):
        assert REGISTRY[name].fn(m).count() > 0, name
    pay = REGISTRY["P2_order_payment"].fn(m)
    assert pay.count() == pay.select("SalesOrderNumber").distinct().count() == REGISTRY["P2_order_payment"].fn(near).count()
    assert pay.where(F.length("SalesOrderNumber") != 14).count() == 0
    inv = REGISTRY["V15_inventory"].fn(m)
    assert inv.count() == inv.select("InventoryKey").distinct().count()


def test_org_chart_has_no_row_limit(spark):
    """More employees than Spark's recursion limit of a million rows."""
    from tessera.plans import measures

    n = 1_200_000
    m = Mart(spark, SF_SMALL)
    k = F.col("id") + 1
    m.__dict__["dim_employee"] = spark.range(n).select(k.alias("EmployeeKey"), F.when(k >= 1000, F.floor(k / 1000)).alias("ParentEmployeeKey"))
    got = measures.m26(m)
    assert got.count() == n
    assert {r["EmployeeKey"]: (r["Depth"], r["Path"]) for r in got.where("EmployeeKey in (5, 5123, 1200000)").collect()} == {
        5: (0, "5"), 5123: (1, "5/5123"), 1200000: (2, "1/1200/1200000")}


def test_max_date_bounds_every_pipeline(spark):
    from tessera.config import MartConfig

    last = dt.date(1997, 1, 1)
    m = Mart(spark, SF_SMALL, MartConfig(max_date=last))
    recent = m.get(gen.gen_order_fulfillment).where(F.col("FulfillmentStatus") == "Shipped")
    assert recent.where(F.col("OrderDate") < F.date_sub(F.lit(last), gen.FUL_RECENT_DAYS)).count() == 0
    assert m.get(gen.gen_customer_survey).where(F.col("SurveyDate") > last).count() == 0
    assert m.get(gen.gen_online_returns).where(F.col("ReturnDate") > last).count() == 0


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from tessera.config import ensure_checkpoint_dir

    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_views_by_name(spark):
    from tessera.plans.build import register_views

    names = register_views(Mart(spark, SF_SMALL))
    assert len(names) == 22
    got = spark.sql("SELECT count(*) AS n FROM fact_vOnlineSales s JOIN dim_vProduct p ON p.ProductKey = s.ProductKey").first()
    assert got["n"] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_linestatus = 'O'").count()


def test_spend_rows_by_hand(spark):
    """P4 and its tier with literal inputs: 10 customers of channel 5 (clicks are
    customers, impressions 3 to 7 each) and decimals as the columns promise."""
    m = Mart(spark, SF_SMALL)
    inject(m, gen.gen_customer_acquisition, spark.createDataFrame(
        [(i, 5, dt.date(1996, 3, 5)) for i in range(10)], "CustomerKey long, AcquisitionChannelKey int, AcquisitionDate date"))
    (r,) = m.get(gen.gen_marketing_spend).collect()
    assert (r.YearMonth, r.MonthStartDateKey, r.AcquisitionChannelKey, r.NewCustomersAcquired, r.Clicks) == (199603, 19960301, 5, 10, 10)
    assert 30 <= r.Impressions <= 70
    types = dict(m.get(gen.gen_marketing_spend).dtypes)
    assert (types["CostPerClick"], types["CostPerAcquisition"], types["ClickThroughRate"]) == ("decimal(19,4)", "decimal(19,4)", "decimal(5,2)")
    cents = (r.MonthlySpend / 10).quantize(Decimal("0.0001"), rounding="ROUND_HALF_UP")
    assert r.CostPerClick == r.CostPerAcquisition == cents
    assert r.ClickThroughRate == (Decimal(1000) / r.Impressions).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    assert dict(m.get(checks_marts.v_sales_quota).dtypes)["GrossMarginQuotaPct"] == "decimal(10,4)"


def test_draws_of_many_salts_are_the_single_draws(spark):
    from tessera.functions import noise, noise_term, noises

    rows = [(0, 1, 2), (-5, 2**31 - 1, 2**31 - 2), (2**62, -2**62, 7), (199801, 10_000, 200_000), (None, 1, 2)]
    salts = ["inv_ss", "inv_cost", "x"]
    for keys in (["a"], ["a", "b"], ["a", "b", "c"]):
        df = spark.createDataFrame(rows, "a long, b long, c long")
        many = noises(salts, *[noise_term(k) for k in keys])
        for r in df.select(F.array(*many).alias("got"), F.array(*[noise(s, *keys) for s in salts]).alias("want")).collect():
            assert r.got == r.want


def test_lines_without_number_or_part_keep_their_place(spark):
    """They get no number, but later lines of their order are counted after them."""
    from tessera.sources.adapter import LINE_ORDER, line_numbers

    rows = [(1, None, 5, 1, 1, 1.0), (1, None, None, 1, 1, 1.0), (1, None, None, 1, 1, 1.0), (1, 1, None, 2, 1, 1.0), (1, 1, 9, 2, 1, 1.0), (1, 2, 10**6, 2, 1, 1.0),
            (1, 2, 10**6, 2, 1, 1.0), (1, 3, 1, None, None, None), (2, 4, 1, 1, 1, 0.5), (None, 1, 1, 1, 1, 1.0), (3, 1, 1, 1, 1, 1.0)]
    df = spark.createDataFrame(rows, "OrderKey long, _ln int, _pk long, _sk long, _sd int, _ep double").repartition(3)
    got = line_numbers(df, spark.createDataFrame([(1, "a"), (2, "b")], "OrderKey long, o string")).collect()
    low = lambda r: [(v is not None, v or 0) for v in r]  # noqa: E731  nulls first
    want = {}
    for order in (1, 2):
        lines = sorted({r for r in rows if r[0] == order}, key=low)
        want |= {r: n for n, r in enumerate(lines, 1) if None not in r[:3]}
    assert {tuple(r[c] for c in LINE_ORDER): r.LineNumber for r in got} == want and len(got) == len(want)
