"""Snapshot publishing for Parquet tables without a transaction log.

Layout under ``root`` (a folder on the cluster's shared file system):

* ``tables/<table>/run=<id>/...``  data written by run ``id``;
* ``_manifest/version=<n>-<token>/``  one small Parquet file listing, for
  every table, the folders that make it up (with row counts and max keys);
* ``_log/etl_runs|etl_events|etl_metrics``  appended run logs.

A run writes its folders first and publishes a new manifest version last,
so a failed run is never visible and no plan overwrites a path it reads.
Facts and closed dimension versions add folders; current dimension rows,
stores and marts replace theirs. Marts also record which fact folders they
cover (``<mart>#covers``: the last covered run), for incremental refreshes.

One writer at a time: a publish names the version it started from and is
refused when another version has appeared since. Every publish has a folder
of its own, so no writer can overwrite another's version, and a folder that
an aborted publish left without data is never listed.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
from pyspark.errors import AnalysisException

from . import schemas as S

_VERSION = re.compile(r"/version=((\d+)-\w+)/")

MANIFEST = StructType([
    StructField("table", StringType(), False), StructField("kind", StringType(), False),
    StructField("path", StringType(), False), StructField("rows", LongType(), False),
    StructField("max_key", LongType(), True)])

#: Conflict keys of the loaded sales, sorted by transaction (W14), and their months.
FACT_KEYS = StructType([*(StructField(c, LongType()) for c in (
    "transaction_id", "product_key", "product_business_key")),
    StructField("year_month", IntegerType())])
#: The fact as it is stored: a folder for each month.
FACT_STORED = StructType([*S.FACT_SALES.fields, StructField("year_month", IntegerType())])

LOG_SCHEMAS = {"etl_runs": S.ETL_RUNS, "etl_events": S.ETL_EVENTS, "etl_metrics": S.ETL_METRICS}

EMPTY_SCHEMAS = {"dim_customer": S.DIM_CUSTOMER, "dim_product": S.DIM_PRODUCT,
                 "dim_store": S.DIM_STORE, "fact_sales": S.FACT_SALES, "fact_keys": FACT_KEYS}


@dataclass
class Part:
    kind: str          # "current" (replaced on publish) or "append" (kept)
    path: str
    rows: int
    max_key: int | None = None


@dataclass
class Snapshot:
    version: int
    name: str = "0-first"
    parts: dict[str, list[Part]] = field(default_factory=dict)

    def rows(self, table: str) -> int:
        return sum(p.rows for p in self.parts.get(table, []))

    def max_key(self, table: str) -> int:
        keys = [p.max_key for p in self.parts.get(table, []) if p.max_key is not None]
        return max(keys) if keys else 0


class Warehouse:
    """Reader / publisher for one warehouse root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._snap: Snapshot | None = None
        #: Frames of the current snapshot: a table's folders are listed once.
        self._frames: dict[str, DataFrame] = {}
        self._ensure_layout()

    def _ensure_layout(self) -> None:
        """A new root gets an empty manifest (version 0) and empty logs, so no
        later read has to probe a missing folder."""
        try:
            self.spark.read.parquet(f"{self.root}/_manifest")
            return
        except AnalysisException:
            pass
        for name, schema in LOG_SCHEMAS.items():
            self.spark.createDataFrame([], schema).write.mode("append").parquet(self.log_path(name))
        (self.spark.createDataFrame([], MANIFEST).write.mode("errorifexists")
         .parquet(f"{self.root}/_manifest/version=0-first"))

    # -- paths --------------------------------------------------------------
    def table_root(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def table_path(self, table: str, run_id: int, part: str | None = None) -> str:
        p = f"{self.table_root(table)}/run={run_id}"
        return f"{p}/part={part}" if part else p

    def staging_path(self, run_id: int, name: str) -> str:
        return f"{self.root}/_staging/run={run_id}/{name}"

    def drop_staging(self, run_id: int) -> None:
        """Remove what a run staged for itself; nothing published refers to it."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_staging/run={run_id}")
        path.getFileSystem(conf).delete(path, True)

    def log_path(self, name: str) -> str:
        return f"{self.root}/_log/{name}"

    # -- manifest -----------------------------------------------------------
    def snapshot(self, refresh: bool = False) -> Snapshot:
        if self._snap is not None and not refresh:
            return self._snap
        # The latest version comes from the file listing, not from reading every
        # version; only its own folder is then read. A version folder without a
        # committed data file (an aborted publish) is not listed.
        files = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest").inputFiles()
        listed = {(int(n), name) for f in files for name, n in _VERSION.findall(f)}
        last = max((n for n, _ in listed), default=0)
        name = min((v for n, v in listed if n == last), default="0-first")
        snap = Snapshot(last, name)
        m = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest/version={name}")
        for r in m.collect():  # one row per folder
            snap.parts.setdefault(r["table"], []).append(
                Part(r["kind"], r["path"], int(r["rows"]), r["max_key"]))
        if self._snap is None or self._snap.name != snap.name:
            self._frames = {}
        self._snap = snap
        return snap

    def publish(self, changes: dict[str, list[Part]], replace: set[str] = frozenset(),
                base: int | None = None) -> Snapshot:
        """New version = old parts, minus replaced 'current' parts, plus ``changes``.

        Tables in ``replace`` drop every old part (marts, stores). ``base`` is the
        version that the caller read; a newer one means a second writer.
        """
        old = self.snapshot(refresh=True)
        if base is not None and old.version != base:
            raise RuntimeError(f"another writer published version {old.version} after {base}; "
                               "a warehouse has one writer at a time")
        parts = {t: list(ps) for t, ps in old.parts.items()}
        for table, new_parts in changes.items():
            kept = [] if table in replace else [
                p for p in parts.get(table, [])
                if not (p.kind == "current" and any(n.kind == "current" for n in new_parts))]
            parts[table] = kept + new_parts
        rows = [(t, p.kind, p.path, p.rows, p.max_key) for t, ps in parts.items() for p in ps]
        name = f"{old.version + 1}-{uuid.uuid4().hex}"
        (self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists")
         .parquet(f"{self.root}/_manifest/version={name}"))
        if self.snapshot(refresh=True).name != name:
            raise RuntimeError("another writer published the same version; this one is void")
        return self._snap

    # -- reading ------------------------------------------------------------
    def __getitem__(self, table: str) -> DataFrame:
        snap = self.snapshot()
        if table not in self._frames:
            self._frames[table] = self._frame(snap, table)
        return self._frames[table]

    def _frame(self, snap: Snapshot, table: str) -> DataFrame:
        paths = [p.path for p in snap.parts.get(table, [])]
        if not paths:
            if table in EMPTY_SCHEMAS:
                return self.spark.createDataFrame([], EMPTY_SCHEMAS[table])
            if table == "dim_date":
                from .sources.calendar import dim_date
                return dim_date(self.spark)
            raise KeyError(table)
        # Folders of several runs form one table: partition discovery starts at
        # the table root; the bookkeeping columns (run, part) are dropped,
        # year_month stays for pruning.
        return self.read_parts(table, paths)

    def read_parts(self, table: str, paths: list[str]) -> DataFrame:
        """Some folders of a table (for example the facts added since a refresh)."""
        reader = self.spark.read.option("basePath", self.table_root(table))
        if table in EMPTY_SCHEMAS:  # known: no job looks for it in the files
            reader = reader.schema(FACT_STORED if table == "fact_sales" else EMPTY_SCHEMAS[table])
        return reader.parquet(*paths).drop("run", "part")

    def rows_of_runs(self, table: str) -> DataFrame:
        """(run_id, rows) that each run has added to a table, counted in its folders."""
        paths = [p.path for p in self.snapshot().parts.get(table, [])]
        if not paths:
            return self.spark.createDataFrame([], "run_id long, rows long")
        found = self.spark.read.option("basePath", self.table_root(table)).parquet(*paths)
        return found.groupBy(F.col("run").cast("long").alias("run_id")).agg(
            F.count(F.lit(1)).alias("rows"))

    def tables(self) -> dict[str, DataFrame]:
        # "<mart>#covers" entries are bookkeeping, not tables.
        names = {"dim_date", *EMPTY_SCHEMAS,
                 *[n for n in self.snapshot().parts if "#" not in n]}
        return {n: self[n] for n in names}

    def read_log(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.log_path(name))
