"""A hot key in a real pipeline: one customer holding a third of all orders.

The order-grain pipelines join the order profile to the customer dimension on
CustomerKey. When that dimension is too large to broadcast the join shuffles by
customer, so a hot customer would land in one task; AQE's skew join must split
it, and the result must still hold every order exactly once."""

from pyspark.sql import functions as F

from tessera.mart import Mart
from tessera.plans import gen
from tests.conftest import SF_MID

SKEW_CONF = {
    # force the shuffled join the cluster would pick for a customer table
    # far beyond the broadcast threshold
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_customer_is_split_and_orders_stay_whole(spark):
    m = Mart(spark, SF_MID)
    heads = m.order_heads
    hot_key = heads.agg(F.min("CustomerKey")).first()[0]
    # every third order moves to one customer: a third of all orders on one key
    m.__dict__["order_heads"] = heads.withColumn(
        "CustomerKey", F.when(F.col("OrderKey") % 3 == 0, F.lit(hot_key)).otherwise(F.col("CustomerKey")))
    profile = gen.order_profile(m)
    orders = profile.count()
    hot_orders = profile.where(F.col("CustomerKey") == hot_key).count()
    assert hot_orders * 4 > orders  # the key really is hot

    def run():
        df = gen.gen_order_payment(m)
        stats = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("SalesOrderNumber").alias("d"),
                       F.sum("PaymentMethodKey").alias("s"))
        row = stats.collect()[0]  # same QueryExecution, so the final adaptive plan is kept
        plan = stats._jdf.queryExecution().executedPlan().toString()
        return row, plan

    base, _ = run()  # default settings: the customer join is broadcast here
    row, plan = _with_conf(spark, SKEW_CONF, run)
    assert tuple(row) == tuple(base) and row.n == row.d == orders
    split = [ln for ln in plan.splitlines() if "SortMergeJoin(skew=true)" in ln and "CustomerKey" in ln]
    assert split and "AQEShuffleRead skewed" in plan, plan


def test_hot_order_is_combined_before_the_shuffle(spark):
    """Most lines on one order: the lines are summed by order map-side, below
    the exchange, and joined to the orders afterwards (P2 and P5)."""
    m = Mart(spark, SF_MID)
    lines = m.order_lines
    hot = lines.agg(F.min("OrderKey")).first()[0]
    m.__dict__["order_lines"] = lines.withColumn("OrderKey", F.when(F.col("ProductKey") % 5 < 3, F.lit(hot)).otherwise(F.col("OrderKey")))
    total = m.order_lines.count()

    def run():
        df = gen.order_totals(m)
        row = df.agg(F.sum("ItemCount").alias("n"), F.max("ItemCount").alias("top"))
        got = row.collect()[0]
        return got, gen.gen_order_payment(m)._jdf.queryExecution().executedPlan().toString(), \
            gen.gen_customer_survey(m)._jdf.queryExecution().executedPlan().toString()

    got, *plans = _with_conf(spark, SKEW_CONF, run)
    assert got["n"] == total and got["top"] * 2 > total
    for plan in plans:
        rows = plan.splitlines()
        for i, row in enumerate(rows):
            if "Exchange hashpartitioning(OrderKey" in row and "l_orderkey" in "\n".join(rows[i:i + 12]):
                assert "HashAggregate(keys=[OrderKey" in "\n".join(rows[i + 1:i + 4]), row
        assert "hashpartitioning(l_orderkey" not in plan


def test_hot_order_is_numbered_in_many_groups(spark):
    """Windows of the line numbering are dealt by ranges of an order's lines."""
    from tessera.sources import adapter

    plan = adapter.fact_online_sales(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    dealt = [row for row in plan.splitlines() if "Exchange hashpartitioning(OrderKey" in row and "_ln" in row and "_range" in row]
    assert dealt
