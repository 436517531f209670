"""Materialise the mart (S3, S7): generated tables, then the view exports.

The reference inserts each pipeline's output into a ``gen`` table and later
exports the views to parquet for the BI layer. Here:

1. each generated table is written to a new version in the store ``<out>/gen``
   (``tessera.store``: idempotent rebuild, S8) in dependency order; later
   pipelines read the written files back (P4 reads P1), which also cuts the
   lineage - a lost executor recomputes from parquet, not from the sales facts;
2. the fact and dimension views are exported to the stores ``<out>/fact`` and
   ``<out>/dim``; date-keyed facts are partitioned by calendar year so readers
   prune partitions, and only years whose rows changed are written again.

A store's tables start to count together, by one rename, after all of them
are written and their rules hold (``check``); ``read_table`` reads them.
Before anything is written, missing input tables or columns are reported all
at once, and a pipeline that needs another one's table refuses to run on a
missing or stale one.

``out_dir`` must be a folder every executor can reach (HDFS/object store on a
cluster; a local path only in local mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import MartConfig
from tessera.mart import RAW_TABLES, Mart
from tessera.plans import checks_fulfilment, checks_marts, checks_returns, checks_survey, dims, facts, gen
from tessera.plans.registry import REGISTRY
from tessera.store import PrerequisiteError, TableStore, inputs_digest

# dependency order: P4 (marketing spend) needs P1 (acquisition)
GEN_ORDER = [gen.gen_customer_acquisition, gen.gen_order_payment, gen.gen_order_fulfillment,
             gen.gen_customer_survey, gen.gen_online_returns, gen.gen_store_returns, gen.gen_marketing_spend]

# pipeline -> those whose tables it reads, and the report of its table's rules (all values 0)
NEEDS = {gen.gen_marketing_spend: [gen.gen_customer_acquisition]}
RULES = {gen.gen_customer_acquisition: "Q15_acquisition_integrity", gen.gen_order_payment: "Q20_payment_integrity",
         gen.gen_order_fulfillment: "Q26_lifecycle_integrity", gen.gen_marketing_spend: "Q32_spend_integrity",
         gen.gen_customer_survey: "Q38_survey_integrity", gen.gen_online_returns: "Q44_online_return_integrity",
         gen.gen_store_returns: "Q50_store_return_integrity"}
# columns that the pipelines read
INPUT_COLUMNS = {
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_returnflag l_linestatus l_shipdate",
    "orders": "o_orderkey o_custkey o_orderdate o_orderpriority", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_type p_brand p_size p_retailprice", "supplier": "s_suppkey s_name s_nationkey",
    "nation": "n_nationkey n_name n_regionkey", "region": "r_regionkey r_name"}

# view name -> (builder, date column to partition by or None)
FACT_EXPORTS = {
    "vOnlineSales": (lambda m: m.get(facts.v_online_sales), "OrderDate"),
    "vStoreSales": (lambda m: m.get(facts.v_store_sales), "SaleDate"),
    "vReturns": (checks_returns.v_returns, "ReturnDate"),
    "vInventory": (lambda m: m.get(checks_marts.v_inventory), "InventoryDate"),
    "vSalesQuota": (lambda m: m.get(checks_marts.v_sales_quota), "SalesQuotaDate"),
    "vExchangeRate": (lambda m: m.get(checks_marts.v_exchange_rate), None),
    "vOrderFulfillment": (lambda m: m.get(checks_fulfilment.v_order_fulfillment), "OrderDate"),
    "vCustomerSurvey": (lambda m: m.get(checks_survey.v_customer_survey), None),
    "vMarketingSpend": (lambda m: m.get(checks_marts.v_marketing_spend), None),
    "vCustomerAcquisition": (lambda m: m.get(checks_marts.v_customer_acquisition), None),
    "vOrderPayment": (lambda m: m.get(checks_marts.v_order_payment), "OrderDate"),
}
DIM_EXPORTS = {
    "vDate": dims.v_date, "vCustomer": dims.v_customer, "vProduct": dims.v_product, "vStore": dims.v_store,
    "vPromotion": dims.v_promotion, "vEmployee": dims.v_employee, "vPaymentMethod": dims.v_payment_method,
    "vAcquisitionChannel": dims.v_acquisition_channel, "vCurrency": dims.v_currency,
    "vReturnReason": dims.v_return_reason, "vChannel": dims.v_channel,
}


SOURCE_TABLES = ["fact_online_sales", "fact_sales", "dim_customer", "dim_product", "dim_product_subcategory",
                 "dim_product_category", "dim_store", "dim_promotion", "dim_employee", "dim_date",
                 "fact_exchange_rate", "fact_inventory", "fact_sales_quota"]


def build_sources(spark: SparkSession, sf_dir: str, out_dir: str, tables=None, parallel: int = 4) -> str:
    """Load the adapted source tables (the source database of the reference) once.

    The tables are independent, so their writes are submitted as concurrent
    Spark jobs (driver threads only submit; all work runs on the executors):
    a stage with few tasks in one job no longer leaves the rest of the cluster
    idle."""
    from concurrent.futures import ThreadPoolExecutor

    src_dir = f"{out_dir.rstrip('/')}/source"
    require_inputs(spark, sf_dir)
    store = TableStore(spark, src_dir)
    digest = Mart(spark, sf_dir).source_digest

    def write(t: str) -> dict:
        return store.stage(t, getattr(Mart(spark, sf_dir), t), digest)

    names = list(tables or SOURCE_TABLES)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        jobs = [pool.submit(write, t) for t in names]
        store.publish({t: f.result() for t, f in zip(names, jobs)})  # re-raises the first failure
    return src_dir


_COMPLETE: set[str] = set()  # digests of inputs that were found complete


def require_inputs(spark: SparkSession, sf_dir: str) -> None:
    """All input tables and columns that the pipelines read are there. The same
    files are looked into once a session."""
    store, lost = TableStore(spark, sf_dir), []
    digest = inputs_digest(spark, sf_dir.rstrip("/"), RAW_TABLES, "columns")
    if digest in _COMPLETE:
        return
    for t in RAW_TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if not store.files.exists(path):
            lost.append(f"{t}: no table at {path}")
            continue
        missing = set(INPUT_COLUMNS[t].split()) - set(spark.read.parquet(path).columns)
        lost += [f"{t}: no column {c}" for c in sorted(missing)]
    if lost:
        raise PrerequisiteError("missing inputs: " + "; ".join(lost))
    _COMPLETE.add(digest)


def require_tables(m: Mart, fn) -> None:
    """The generated tables that pipeline ``fn`` reads are there and fresh."""
    for need in NEEDS.get(fn, []):
        entry = m.staged.get(need.gen_table) or TableStore(m.spark, m.gen_dir).entries().get(need.gen_table)
        if entry is None or entry["digest"] != m.gen_digest:
            raise PrerequisiteError(f"{fn.gen_table} needs {need.gen_table}, which is {'missing' if entry is None else 'stale'}: build it first")


def broken_rules(m: Mart, fn) -> list[str]:
    """Rules of a pipeline's table that some row breaks, with counts."""
    if fn not in RULES:
        return []
    name, value = (rows := REGISTRY[RULES[fn]].fn(m)).columns[:2]
    return [f"{r[name]}: {r[value]}" for r in rows.collect() if r[value]]  # a handful of rows


def build_gen(spark: SparkSession, sf_dir: str, out_dir: str, cfg: MartConfig | None = None,
              source_dir: str | None = None, only=None, parallel: int = 1, check: bool = False) -> Mart:
    """Write P1-P7 (or ``only`` of them) and return a Mart that reads them back.

    With ``parallel > 1`` the pipelines that do not read another generated table
    are submitted as concurrent jobs; P4 (reads P1) runs after them. The tables
    start to count together, at the end. With ``check``, only if no rule of
    theirs is broken."""
    from concurrent.futures import ThreadPoolExecutor

    gen_dir = f"{out_dir.rstrip('/')}/gen"
    store = TableStore(spark, gen_dir)
    require_inputs(spark, sf_dir)
    staged: dict[str, dict] = {}

    def mart(**more) -> Mart:
        return Mart(spark, sf_dir, cfg, gen_dir=gen_dir, source_dir=source_dir, **more)

    def write(fn) -> None:
        m = mart(staged=dict(staged))  # sees tables written so far
        require_tables(m, fn)
        staged[fn.gen_table] = store.stage(fn.gen_table, fn(m), m.gen_digest)  # build fresh, read deps back

    todo = list(only or GEN_ORDER)
    if parallel > 1:
        first = [fn for fn in todo if fn not in NEEDS]
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            for f in [pool.submit(write, fn) for fn in first]:
                f.result()
        todo = [fn for fn in todo if fn in NEEDS]
    for fn in todo:
        write(fn)
    if check:
        m = mart(staged=staged)
        broken = [f"{fn.gen_table}: {said}" for fn in (only or GEN_ORDER) for said in broken_rules(m, fn)]
        if broken:
            raise ValueError("rules broken, tables not published: " + "; ".join(broken))
    store.publish(staged)
    return mart()


def read_table(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A published table by its folder and name, such as ``fact/vOnlineSales``."""
    kind, table = name.split("/")
    return TableStore(spark, f"{out_dir.rstrip('/')}/{kind}").read(table)


def register_views(m: Mart) -> list[str]:
    """Make every view readable by name in ``spark.sql``: ``dim_vDate``,
    ``fact_vOnlineSales`` and so on. Returns the names."""
    names = []
    for kind, views in (("dim", {n: (lambda mm, fn=fn: mm.get(fn)) for n, fn in DIM_EXPORTS.items()}),
                        ("fact", {n: fn for n, (fn, _) in FACT_EXPORTS.items()})):
        for name, fn in views.items():
            fn(m).createOrReplaceTempView(f"{kind}_{name}")
            names.append(f"{kind}_{name}")
    return names


def build_all(spark: SparkSession, sf_dir: str, out_dir: str, cfg: MartConfig | None = None) -> Mart:
    """Source tables and generated tables once, then the parquet export of every view."""
    source = build_sources(spark, sf_dir, out_dir)
    m = build_gen(spark, sf_dir, out_dir, cfg, source_dir=source, parallel=4, check=True)
    export(m, out_dir)
    return m


def export(m: Mart, out_dir: str) -> None:
    """Every view to the stores ``fact`` and ``dim``."""
    for kind, views in (("fact", FACT_EXPORTS), ("dim", {n: (lambda mm, fn=fn: mm.get(fn), None) for n, fn in DIM_EXPORTS.items()})):
        store = TableStore(m.spark, f"{out_dir.rstrip('/')}/{kind}")
        store.publish({name: store.stage(name, fn(m), m.gen_digest, year_of) for name, (fn, year_of) in views.items()})
