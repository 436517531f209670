"""Versioned tables behind one pointer (S3 guard, S7, S8).

A store is a folder. Every write of a table goes to a new version folder, and
one small file, ``_current.json``, says which version of each table counts,
what it was built from (a digest) and its schema. Publishing replaces that
file by one rename, so a reader sees either all old or all new tables; a build
that fails before leaves the old ones as they were.

Tables written ``by_year`` keep a digest of the rows of each year: a rebuild
writes only the years whose rows changed and goes on pointing to the files of
the others.

One build at a time publishes to a store. Old versions stay for readers that
still have them open, until ``vacuum``.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_current.json"
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"  # the writers' name for a null partition value


class PrerequisiteError(RuntimeError):
    """Tables or columns that a build needs are missing or stale."""


class Files:
    """Small files and listings through Hadoop's FileSystem (local, HDFS, object stores)."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Write beside and rename over ``path``."""
        beside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        p, fs = self._at(beside)
        stream = fs.create(p, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        target, _ = self._at(path)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        over = self.gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(p, target, over)

    def listing(self, path: str) -> list[tuple[str, int, int]]:
        """Name, length and time of every file below ``path``."""
        p, fs = self._at(path)
        if not fs.exists(p):
            return []
        out, found = [], fs.listFiles(p, True)
        while found.hasNext():
            f = found.next()
            out.append((f.getPath().toUri().getPath(), f.getLen(), f.getModificationTime()))
        return sorted(out)

    def children(self, path: str) -> list[str]:
        p, fs = self._at(path)
        return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)


@lru_cache(maxsize=1)
def code_digest() -> str:
    """Digest of the modules whose constants and rules decide what tables hold."""
    from tessera import functions
    from tessera.operators import argmax
    from tessera.plans import gen
    from tessera.sources import adapter, reference

    text = "".join(inspect.getsource(mod) for mod in (functions, argmax, adapter, reference, gen))
    return hashlib.sha256(text.encode()).hexdigest()


def inputs_digest(spark: SparkSession, sf_dir: str, tables: list[str], config: str) -> str:
    """Digest of the input files (path, length, time), the code and ``config``."""
    files = Files(spark)
    seen = {t: files.listing(f"{sf_dir}/{t}.parquet") for t in tables}
    return hashlib.sha256(json.dumps([seen, code_digest(), config], sort_keys=True).encode()).hexdigest()


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def entries(self) -> dict[str, dict]:
        path = f"{self.root}/{POINTER}"
        return json.loads(self.files.read(path)) if self.files.exists(path) else {}

    # ---- writing ---------------------------------------------------------
    def stage(self, name: str, df: DataFrame, digest: str, year_of: str | None = None) -> dict:
        """Write a new version of a table, which nobody reads yet; returns its entry."""
        version = f"v-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}/{version}"
        if year_of is None:
            df.write.option("maxRecordsPerFile", 5_000_000).parquet(path)
            return {"digest": digest, "schema": df.schema.jsonValue(), "version": version}
        df = df.withColumn("Year", F.year(year_of))
        marks = _year_marks(df)
        old = self.entries().get(name, {})
        same_form = old.get("schema") == df.schema.jsonValue()
        years = {y: old["years"][y] for y, mark in marks.items() if same_form and old.get("years", {}).get(y, {}).get("mark") == mark}
        changed = [y for y in marks if y not in years]
        if changed:
            is_changed = F.coalesce(F.col("Year").cast("string"), F.lit(NO_YEAR)).isin(changed)
            # Rebalanced by year, which Spark splits where a year is large: few
            # files a year, and no year in one task
            (df.where(is_changed).hint("rebalance", "Year").write.option("maxRecordsPerFile", 5_000_000).partitionBy("Year").parquet(path))
        years |= {y: {"mark": marks[y], "version": version} for y in changed}
        return {"digest": digest, "schema": df.schema.jsonValue(), "years": years}

    def publish(self, entries: dict[str, dict]) -> None:
        """Let the staged versions count, all at once."""
        self.files.replace(f"{self.root}/{POINTER}", json.dumps(self.entries() | entries, sort_keys=True))

    def vacuum(self) -> list[str]:
        """Remove versions that the pointer does not name; returns their folders."""
        gone = []
        for name, entry in self.entries().items():
            kept = {entry["version"]} if "version" in entry else {y["version"] for y in entry["years"].values()}
            for version in self.files.children(f"{self.root}/{name}"):
                if version.startswith("v-") and version not in kept:
                    gone.append(f"{self.root}/{name}/{version}")
                    self.files.delete(gone[-1])
        return gone

    # ---- reading ---------------------------------------------------------
    def read(self, name: str, entry: dict | None = None) -> DataFrame:
        """The published version of a table, or that of a staged ``entry``."""
        entry = entry or self.entries()[name]
        schema, base = StructType.fromJson(entry["schema"]), f"{self.root}/{name}"
        if "version" in entry:
            return self.spark.read.schema(schema).parquet(f"{base}/{entry['version']}")
        versions: dict[str, list[str]] = {}
        for year, part in sorted(entry["years"].items()):
            versions.setdefault(part["version"], []).append(f"{base}/{part['version']}/Year={year}")
        out = self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).option("basePath", f"{base}/{v}").parquet(*paths) for v, paths in versions.items()]
        for k, part in enumerate(parts):
            out = part if k == 0 else out.unionByName(part)
        return out


def _year_marks(df: DataFrame) -> dict[str, str]:
    """Number of rows and sum of their hashes for each year (a handful of rows)."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
    rows = df.groupBy("Year").agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("h")).collect()
    return {NO_YEAR if r["Year"] is None else str(r["Year"]): f"{r['n']}:{r['h']}" for r in rows}
