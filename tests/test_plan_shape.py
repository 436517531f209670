"""Physical plan shape: the properties that matter at scale."""

from tessera.plans.registry import REGISTRY
from tests.conftest import SF_SMALL


def plan(mart, name):
    return REGISTRY[name].fn(mart)._jdf.queryExecution().executedPlan().toString()


def final_plan(spark, df):
    """The adaptive plan as it was run, with no table small enough to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = df.alias("x")
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return text.split("== Initial Plan ==")[0]


def test_order_grain_pipelines_read_the_lines_once(spark):
    """The date bounds reuse the exchange of the lines' sums by order."""
    from tessera.mart import Mart

    for name in ("P2_order_payment", "P3_order_fulfillment"):
        p = final_plan(spark, REGISTRY[name].fn(Mart(spark, SF_SMALL)))
        assert p.count("lineitem.parquet") == 1, (name, p)
        assert "hashpartitioning(l_orderkey" not in p and "SortAggregate(key=[OrderKey" not in p, name
        for i, row in enumerate(rows := p.splitlines()):  # raw lines are never shuffled
            if "Exchange hashpartitioning(OrderKey" in row and "lineitem" in "\n".join(rows[i:i + 8]):
                assert "HashAggregate(keys=[OrderKey" in "\n".join(rows[i + 1:i + 4]), row


MEASURES = ("l_quantity", "l_discount", "l_returnflag", "SalesAmount", "SalesQuantity", "ReturnAmount", "TotalCost", "UnitPrice")


def test_numbering_shuffles_line_identities_only(mart):
    """Below every window of the line numbering there is no measure, and lines
    with measures are shuffled once, by their identity."""
    for name in ("V12_online_sales", "V13_store_sales", "P6_online_returns", "P7_store_returns"):
        rows = plan(mart, name).splitlines()
        wide = 0
        for i, row in enumerate(rows):
            depth = len(row) - len(row.lstrip(" :+-"))
            below = []
            for nxt in rows[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                below.append(nxt)
            if "Window [" in row and "_range" in row:
                assert not any(m in "\n".join([row, *below]) for m in MEASURES), (name, row)
            if "Exchange hashpartitioning" in row and "SalesAmount" in "\n".join(below) + row:
                wide += 1
                assert all(c in row for c in ("OrderKey", "_ln", "_pk", "_sk", "_sd", "_ep")), (name, row)
        assert wide <= 1, name


def test_argmax_adds_no_cross_join(mart):
    p = plan(mart, "P1_customer_acquisition")
    assert "CartesianProduct" not in p and "Expand" not in p


GROWING = ("lineitem", "orders", "customer", "part.parquet", "supplier")


def single_partition_inputs(p):
    """For each single-partition exchange, the scans beneath it."""
    lines = p.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


def test_no_single_partition_exchange_on_growing_tables(mart):
    # Single-partition windows are allowed only over fixed-size tables
    # (8 return reasons, 25 geography rows) or already-aggregated frames.
    for name in ("V12_online_sales", "V13_store_sales", "P6_online_returns", "P7_store_returns",
                 "V18_order_fulfillment", "P3_order_fulfillment", "V15_inventory"):
        for sub in single_partition_inputs(plan(mart, name)):
            first = sub.splitlines()[0] if sub else ""
            if "Aggregate(" in first and "partial_" in first:
                continue  # global aggregate: one partial row per task crosses the exchange
            assert not any(t in sub for t in GROWING), (name, sub[:500])


def test_filters_and_columns_reach_the_scan(mart):
    p = REGISTRY["P2_order_payment"].fn(mart)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)" in p
    assert "ReadSchema: struct<l_orderkey:bigint" in p and "l_tax" not in p and "l_comment" not in p
    assert "l_shipdate" not in p  # only the line-identity columns of keyed views read it


def test_line_keys_use_no_per_order_window_over_lines(mart):
    # A window over lines by order alone would put a hot order in one task; only
    # the starts of the groups (one row per group) are summed by order.
    for name in ("V12_online_sales", "V13_store_sales", "P6_online_returns"):
        windows = [line for line in plan(mart, name).splitlines() if "Window [" in line]
        assert any("dense_rank(" in w and "_range" in w for w in windows), name
        assert not any("rank(" in w and "_range" not in w and "OrderKey" in w for w in windows), (name, windows)


def test_no_job_runs_while_line_views_are_built(spark, mart):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    try:
        for name in ("V12_online_sales", "V13_store_sales", "P6_online_returns", "P7_store_returns", "V14_returns"):
            REGISTRY[name].fn(mart)
        assert not tracker.getJobIdsForGroup("build-only")
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_inventory_draws_fit_into_compiled_methods(spark):
    """the JVM does not compile methods over 8000 bytes, and a lambda is
    interpreted by Spark; F4: what does not read the flag does not look for the last snapshot."""
    import re

    from tessera.mart import Mart

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("S1_fact_inventory", "V15_inventory", "Q68_stock_status_share"):
            execution = REGISTRY[name].fn(Mart(spark, SF_SMALL))._jdf.queryExecution()
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", execution.explainString(mode))]
            text = execution.executedPlan().toString()
            assert sizes and max(sizes) < 8000 and "lambda" not in text, (name, sizes)
            assert name != "Q68_stock_status_share" or text.count("lineitem.parquet") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_line_identities_are_shuffled_once(spark):
    """places and starts of the line numbering read one shuffle of the identities."""
    import re

    from tessera.mart import Mart

    for name in ("P6_online_returns", "P7_store_returns"):
        rows = final_plan(spark, REGISTRY[name].fn(Mart(spark, SF_SMALL))).splitlines()
        places = [i for i, row in enumerate(rows) if re.search(r"Window \[dense_rank", row)]
        assert len(places) == 2, name
        assert sum("ReusedExchange" in "\n".join(rows[i + 1:i + 8]) for i in places) == 1, (name, "\n".join(rows))
