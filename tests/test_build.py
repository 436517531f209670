"""Materialisation (S3/S7/S8): gen tables written in dependency order, read back,
views exported; a rebuild overwrites idempotently."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.config import MartConfig
from tessera.mart import RAW_TABLES, Mart
from tessera.plans import build, gen
from tessera.store import PrerequisiteError, TableStore
from tests.conftest import SF_SMALL


def same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.fixture(scope="module")
def built(spark):
    out = tempfile.mkdtemp(prefix="tessera-build-", dir="/tmp")
    return out, build.build_all(spark, SF_SMALL, out)


def test_build_all_roundtrip(spark, built):
    out, m = built
    fresh = Mart(spark, SF_SMALL)
    entries = TableStore(spark, f"{out}/gen").entries()
    for fn in build.GEN_ORDER:
        assert fn.gen_table in entries
        assert same(m.get(fn), fresh.get(fn)), fn.__name__  # read back from parquet, recomputed
    sales = build.read_table(spark, out, "fact/vOnlineSales")
    assert "Year" in sales.columns and sales.count() == fresh.fact_online_sales.count()
    # a rebuild gives the same tables
    build.build_gen(spark, SF_SMALL, out)
    again = Mart(spark, SF_SMALL, gen_dir=f"{out}/gen").get(gen.gen_marketing_spend)
    assert again.count() == fresh.get(gen.gen_marketing_spend).count()


def test_every_view_is_exported(spark, built):
    out, m = built
    names = [f"fact/{n}" for n in build.FACT_EXPORTS] + [f"dim/{n}" for n in build.DIM_EXPORTS]
    assert len(names) == 22
    build.register_views(m)
    for name in names:
        kept = build.read_table(spark, out, name)
        assert same(kept.drop("Year"), spark.table(name.replace("/", "_")).drop("Year")), name


def test_tables_of_another_configuration_are_not_read(spark, built):
    out, _ = built
    cfg = MartConfig(max_date=dt.date(1997, 1, 1))
    fresh = Mart(spark, SF_SMALL, cfg).get(gen.gen_online_returns)
    with pytest.warns(UserWarning, match="online_return_events was built from other"):
        got = Mart(spark, SF_SMALL, cfg, gen_dir=f"{out}/gen").get(gen.gen_online_returns)
    assert same(got, fresh) and got.where(F.col("ReturnDate") > cfg.max_date).count() == 0
    with pytest.raises(PrerequisiteError, match="other inputs"):
        Mart(spark, SF_SMALL, cfg, gen_dir=f"{out}/gen", stale="refuse").get(gen.gen_online_returns)
    # the source tables do not depend on the configuration
    assert Mart(spark, SF_SMALL, cfg, source_dir=f"{out}/source", stale="refuse").dim_store.count() > 0
    with pytest.raises(PrerequisiteError, match="needs customer_acquisition, which is stale"):
        build.build_gen(spark, SF_SMALL, out, cfg, only=[gen.gen_marketing_spend])


def test_missing_prerequisites_are_named(spark, tmp_path):
    for t in RAW_TABLES[2:]:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        (df.drop("p_size") if t == "part" else df).write.parquet(f"{tmp_path}/in/{t}.parquet")
    with pytest.raises(PrerequisiteError, match="lineitem: no table.*orders: no table.*part: no column p_size"):
        build.build_sources(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    with pytest.raises(PrerequisiteError, match="needs customer_acquisition, which is missing"):
        build.build_gen(spark, SF_SMALL, f"{tmp_path}/out", only=[gen.gen_marketing_spend])


def test_a_failed_build_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    build.build_gen(spark, SF_SMALL, out, only=[gen.gen_customer_acquisition])
    before = TableStore(spark, f"{out}/gen")
    rows, entry = sorted(before.read("customer_acquisition").collect()), before.entries()

    @gen.gen_table("customer_acquisition")
    def fails(m):
        return gen.gen_customer_acquisition(m).withColumn("AcquisitionChannelKey", F.raise_error(F.lit("lost")).cast("int"))

    @gen.gen_table("customer_acquisition")
    def breaks_rules(m):
        return gen.gen_customer_acquisition(m).withColumn("AcquisitionChannelKey", F.lit(77))

    with pytest.raises(Exception, match="lost"):
        build.build_gen(spark, SF_SMALL, out, only=[fails])
    monkeypatch.setitem(build.RULES, breaks_rules, build.RULES[gen.gen_customer_acquisition])
    with pytest.raises(ValueError, match="rules broken, tables not published: customer_acquisition"):
        build.build_gen(spark, SF_SMALL, out, only=[breaks_rules], check=True)
    assert before.entries() == entry and sorted(before.read("customer_acquisition").collect()) == rows
    assert len(before.vacuum()) == 2 and sorted(before.read("customer_acquisition").collect()) == rows


def test_only_changed_years_are_written(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    days = spark.range(900).select("id", F.date_add(F.lit("2001-06-01").cast("date"), F.col("id").cast("int")).alias("d"))
    days = days.unionByName(spark.createDataFrame([(-1, None)], "id long, d date"))
    store.publish({"t": store.stage("t", days, "one", "d")})
    first = store.entries()["t"]["years"]
    assert len(first) == 4 and same(days, store.read("t").drop("Year"))
    changed = days.withColumn("id", F.when(F.year("d") == 2002, F.col("id") + 1).otherwise(F.col("id"))).where("d is null or year(d) > 2001")
    store.publish({"t": store.stage("t", changed, "two", "d")})
    second = store.entries()["t"]["years"]
    assert set(first) - set(second) == {"2001"}
    assert {y for y in second if second[y] != first[y]} == {"2002"}
    assert same(changed, store.read("t").drop("Year")) and store.read("t").where("Year = 2002").count() == 365
    assert store.vacuum() == [] and same(changed, store.read("t").drop("Year"))


def test_build_sources_concurrently(spark):
    out = tempfile.mkdtemp(prefix="tessera-src-", dir="/tmp")
    src = build.build_sources(spark, SF_SMALL, out, tables=["dim_store", "dim_date", "fact_exchange_rate"])
    fresh = Mart(spark, SF_SMALL)
    m = Mart(spark, SF_SMALL, source_dir=src)
    for t in ("dim_store", "dim_date", "fact_exchange_rate"):
        a, b = getattr(m, t), getattr(fresh, t)
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0, t
