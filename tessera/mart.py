"""The mart: lazily built source, generated and view DataFrames for one dataset.

A ``Mart`` is cheap to create; every table is an unevaluated DataFrame built
on first access and memoised for the lifetime of the object, so a report that
touches the same view twice shares one logical subtree (and Spark's exchange
reuse shares the shuffle). If ``gen_dir`` is given, generated tables that were
written there by :func:`tessera.plans.build.build_all` are read back instead
of recomputed - the analogue of the reference's persisted ``gen`` schema. A
table is read back only if it was built from the same input files, code and
configuration (``tessera.store``); a stale one is recomputed with a warning,
or refused with ``stale="refuse"``.
"""

from __future__ import annotations

import warnings
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import MartConfig, ensure_checkpoint_dir
from tessera.sources import adapter, reference
from tessera.store import PrerequisiteError, TableStore, inputs_digest

SHIFT = 16  # years added to every source date (fixed value of the reference)


RAW_TABLES = ["lineitem", "orders", "customer", "part", "supplier", "nation", "region"]


class Mart:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: MartConfig | None = None,
                 gen_dir: str | None = None, source_dir: str | None = None, stale: str = "rebuild",
                 staged: dict[str, dict] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.cfg = cfg or MartConfig()
        self.gen_dir = gen_dir
        self.source_dir = source_dir
        self.stale = stale
        self.staged = staged or {}  # versions of this build, not published yet
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)

    # ---- source tables -------------------------------------------------
    @cached_property
    def fact_online_sales(self) -> DataFrame:
        return self._source("fact_online_sales", lambda: adapter.fact_online_sales(self.spark, self.sf_dir))

    @cached_property
    def online_lines(self) -> DataFrame:
        """Online sales lines without line keys (for aggregations)."""
        return self._source("fact_online_sales", lambda: adapter.online_lines(self.spark, self.sf_dir))

    @cached_property
    def order_lines(self) -> DataFrame:
        """Online sales lines with their order key and measures, not joined to the orders."""
        if self._loaded("fact_online_sales"):
            return self.online_lines
        return adapter.line_measures(self.spark, self.sf_dir, "O")

    @cached_property
    def store_line_sums(self) -> DataFrame:
        """Store sales lines with their measures, not joined to the orders."""
        if self._loaded("fact_sales"):
            return self.store_lines
        return adapter.line_measures(self.spark, self.sf_dir, "F")

    @cached_property
    def order_heads(self) -> DataFrame:
        """Date and customer of every order."""
        return adapter.order_heads(self.spark, self.sf_dir)

    @cached_property
    def store_lines(self) -> DataFrame:
        """Store sales lines without the line key (for aggregations)."""
        return self._source("fact_sales", lambda: adapter.store_lines(self.spark, self.sf_dir))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._source("fact_sales", lambda: adapter.fact_sales(self.spark, self.sf_dir))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._source("dim_customer", lambda: adapter.dim_customer(self.spark, self.sf_dir))

    @cached_property
    def dim_geography(self) -> DataFrame:
        return adapter.dim_geography(self.spark, self.sf_dir)

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._source("dim_product", lambda: adapter.dim_product(self.spark, self.sf_dir))

    @cached_property
    def dim_product_subcategory(self) -> DataFrame:
        return self._source("dim_product_subcategory", lambda: adapter.dim_product_subcategory(self.spark, self.sf_dir))

    @cached_property
    def dim_product_category(self) -> DataFrame:
        return self._source("dim_product_category", lambda: adapter.dim_product_category(self.spark, self.sf_dir))

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._source("dim_store", lambda: adapter.dim_store(self.spark, self.sf_dir))

    @cached_property
    def dim_promotion(self) -> DataFrame:
        return self._source("dim_promotion", lambda: adapter.dim_promotion(self.spark, self.sf_dir))

    @cached_property
    def dim_employee(self) -> DataFrame:
        return self._source("dim_employee", lambda: adapter.dim_employee(self.spark, self.sf_dir))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._source("dim_date", lambda: adapter.dim_date(self.spark, self.sf_dir))

    @cached_property
    def dim_channel(self) -> DataFrame:
        return adapter.dim_channel(self.spark)

    @cached_property
    def dim_scenario(self) -> DataFrame:
        return adapter.dim_scenario(self.spark)

    @cached_property
    def dim_currency(self) -> DataFrame:
        return adapter.dim_currency(self.spark)

    @cached_property
    def fact_exchange_rate(self) -> DataFrame:
        return self._source("fact_exchange_rate", lambda: adapter.fact_exchange_rate(self.spark, self.sf_dir))

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return self._source("fact_inventory", lambda: adapter.fact_inventory(self.spark, self.sf_dir))

    @cached_property
    def fact_sales_quota(self) -> DataFrame:
        return self._source("fact_sales_quota", lambda: adapter.fact_sales_quota(self.spark, self.sf_dir))

    # ---- reference dims (literal, 7/7/8 rows) ---------------------------
    @cached_property
    def ref_acquisition_channel(self) -> DataFrame:
        return reference.acquisition_channels(self.spark)

    @cached_property
    def ref_payment_method(self) -> DataFrame:
        return reference.payment_methods(self.spark)

    @cached_property
    def ref_return_reason(self) -> DataFrame:
        return reference.return_reasons(self.spark)

    # ---- scalars (one-row frames, S4) -----------------------------------
    @cached_property
    def scalars(self) -> DataFrame:
        """One row: max_date (latest order date), reference_date, as_of.

        A one-row aggregate over the orders' date column; joined to big
        frames with a broadcast cross join so it never forces a collect.
        """
        cfg = self.cfg
        o = adapter.read(self.spark, self.sf_dir, "orders")
        row = o.agg(F.max("o_orderdate").cast("date").alias("max_date"))
        if cfg.max_date is not None:
            row = row.select(F.lit(cfg.max_date).alias("max_date"))
        ref = (F.lit(cfg.reference_date) if cfg.reference_date is not None
               else F.make_date(F.year("max_date") + SHIFT, F.lit(12), F.lit(31)))
        row = row.withColumn("reference_date", ref)
        as_of = F.lit(cfg.as_of) if cfg.as_of is not None else F.col("reference_date")
        return F.broadcast(row.withColumn("as_of", as_of))

    def with_scalars(self, df: DataFrame, *names: str) -> DataFrame:
        s = self.scalars.select(*(names or ("max_date", "reference_date", "as_of")))
        return df.crossJoin(F.broadcast(s))

    # ---- memoised derived frames ----------------------------------------
    def get(self, fn) -> DataFrame:
        """Build ``fn(self)`` once per mart (views, generated tables, reports)."""
        memo = self.__dict__.setdefault("_memo", {})
        key = fn.__module__ + "." + fn.__name__
        if key not in memo:
            gen_name = getattr(fn, "gen_table", None)
            memo[key] = self._gen(gen_name, lambda: fn(self)) if gen_name else fn(self)
        return memo[key]

    # ---- persisted source / generated tables -----------------------------
    @cached_property
    def source_digest(self) -> str:
        """What the source tables are built from: input files and code."""
        return inputs_digest(self.spark, self.sf_dir, RAW_TABLES, "source")

    @cached_property
    def gen_digest(self) -> str:
        """What the generated tables are built from: also the configuration."""
        return inputs_digest(self.spark, self.sf_dir, RAW_TABLES, repr(self.cfg))

    def _stored(self, root: str | None, name: str, digest: str) -> DataFrame | None:
        """The table, if the store has it and it was built from ``digest``."""
        if not root:
            return None
        store = TableStore(self.spark, root)
        entry = self.staged.get(name) or self._entries(root).get(name)
        if entry is None:
            return None
        if entry["digest"] == digest:
            return store.read(name, entry)
        said = f"{root}/{name} was built from other inputs, code or configuration"
        if self.stale == "refuse":
            raise PrerequisiteError(said)
        warnings.warn(f"{said}; it is computed anew", stacklevel=2)
        return None

    def _entries(self, root: str) -> dict[str, dict]:
        """The store's pointer, read once: a mart sees one state of it."""
        seen = self.__dict__.setdefault("_pointers", {})
        if root not in seen:
            seen[root] = TableStore(self.spark, root).entries()
        return seen[root]

    def _source(self, name: str, build) -> DataFrame:
        """Adapted source table: read from ``source_dir`` when it was loaded there."""
        got = self._stored(self.source_dir, name, self.source_digest) if self.source_dir else None
        return build() if got is None else got

    def _loaded(self, name: str) -> bool:
        return bool(self.source_dir) and self._stored(self.source_dir, name, self.source_digest) is not None

    def _gen(self, name: str, build) -> DataFrame:
        got = self._stored(self.gen_dir, name, self.gen_digest) if self.gen_dir else None
        return build() if got is None else got
