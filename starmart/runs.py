"""Audited runs that publish snapshots.

A run appends one ``etl_runs`` row per status change (RUNNING, then SUCCESS
or FAILED), events and metrics to logs kept apart from the data, so a
FAILED row survives a failed run. Data becomes visible only through the
manifest published at the end.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import time
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import config as C
from . import schemas as S
from .catalog import Part, Warehouse
from .functions.dates import year_month
from .loads import Staged, load_dimensions
from .operators.facts import (SALES_KEY_ORDER, conflict_columns, conflict_marked,
                              dedupe_in_order, resolve_for_order, resolve_sales)
from .operators.layout import layout_order
from .plans.marts import INCREMENTAL, MARTS, STORE_PAIRS, store_pairs, store_region_of
from .session import concurrently, default_parallelism
from .sources.calendar import dim_date


_TRACE = os.environ.get("STARMART_TRACE") == "1"


def _trace(run: "Run", what: str, t0: float) -> float:
    """Phase timings on stderr when STARMART_TRACE=1."""
    t1 = time.perf_counter()
    if _TRACE:
        print(f"[run {run.run_id}] {what}: {t1 - t0:.2f}s", file=sys.stderr, flush=True)
    return t1


@contextmanager
def observing(spark):
    """Adaptive execution must not replace an empty plan: its observations would go too."""
    key, rule = ("spark.sql.adaptive.optimizer.excludedRules",
                 "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation")
    old = spark.conf.get(key, "")
    spark.conf.set(key, ",".join(filter(None, [old, rule])))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Run:
    """Bookkeeping for one run: id, status rows, events, metrics."""

    def __init__(self, wh: Warehouse, kind: str, message: str | None = None):
        self.wh, self.kind = wh, kind
        last = wh.read_log("etl_runs", S.ETL_RUNS).agg(F.max("run_id")).first()[0]
        self.run_id = int(last or 0) + 1
        self._events: list[tuple] = []
        self._metrics: list[tuple] = []
        self._status("RUNNING", message)

    def _append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.wh.log_path(name))

    def _rows(self, name: str, rows: list[tuple], schema) -> None:
        """A few driver-side rows: one file."""
        self._append(name, self.wh.spark.createDataFrame(rows, schema).coalesce(1))

    def _status(self, status: str, message: str | None) -> None:
        self._rows("etl_runs", [(self.run_id, self.kind, status, message, _now())], S.ETL_RUNS)

    def event(self, step: str, level: str, message: str) -> None:
        """Driver-side step events are buffered and written once per run."""
        self._events.append((self.run_id, step, level.upper(), message, _now()))

    def events(self, df: DataFrame) -> None:
        """Append a change feed computed on executors."""
        self._append("etl_events", df.select(
            F.lit(self.run_id).cast("long").alias("run_id"), "step", "level", "message",
            F.current_timestamp().alias("created_at")))

    def metric(self, name: str, value: int) -> None:
        from decimal import Decimal
        self._metrics.append((self.run_id, name, Decimal(value).quantize(Decimal("0.01")),
                              _now()))

    def _flush(self) -> None:
        if self._events:
            self._rows("etl_events", self._events, S.ETL_EVENTS)
        if self._metrics:
            self._rows("etl_metrics", self._metrics, S.ETL_METRICS)
        self._events, self._metrics = [], []

    def succeed(self, message: str | None = None) -> None:
        self._flush()
        self._status("SUCCESS", message)

    def fail(self, exc: BaseException, step: str) -> None:
        msg = f"{type(exc).__name__}: {exc}"
        self.event(step, "ERROR", msg)
        self._flush()
        self._status("FAILED", msg)


def write_observed(df: DataFrame, path: str, *aggs) -> dict:
    """Write ``df``; the row count and ``aggs``, observed during the write itself."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *aggs).write.mode(
        "errorifexists").parquet(path)
    return {"rows": 0, **{k: v for k, v in obs.get.items() if v is not None}}


def _count_if(cond, name: str):
    return F.count(F.when(cond, 1)).alias(name)


KEY_COLUMNS = ("product_key", "store_key", "customer_key")
DIMENSIONS = (("customers", "customer_business_key", C.METRIC_CUSTOMER_ROWS),
              ("products", "product_business_key", C.METRIC_PRODUCT_ROWS),
              ("stores", "store_business_key", C.METRIC_STORE_ROWS))


def materialize(run: Run, staged: Staged, dimensions: bool = True) -> tuple[Staged, dict]:
    """Write the staged frames once under the run's staging folder.

    Later steps read these files and never the sources again. Rows that the
    tables would refuse are counted during the write: a null business key or a
    text over its declared length fails the run.
    """
    wh = run.wh

    def dimension(name: str, bk: str, metric: str) -> DataFrame:
        path, limits, df = wh.staging_path(run.run_id, name), C.VARCHAR_LIMITS[name], getattr(staged, name)
        got = write_observed(df, path, _count_if(F.col(bk).isNull(), bk),
                             *[_count_if(F.length(c) > n, c) for c, n in limits.items()])
        run.metric(metric, got["rows"])
        if got.get(bk):
            raise ValueError(f"{got[bk]} staged {name} rows have a null business key")
        long = {c: got[c] for c in limits if got.get(c)}
        if long:
            raise ValueError(f"staged {name} rows with over-long text: {long}")
        return wh.spark.read.schema(df.schema).parquet(path)

    def sales() -> tuple[DataFrame, dict]:
        path = wh.staging_path(run.run_id, "sales")
        seen = write_observed(staged.sales, path, *[
            fn(c).alias(f"{which}_{c}") for c in ("transaction_date", "transaction_id")
            for which, fn in (("min", F.min), ("max", F.max))])
        return wh.spark.read.schema(staged.sales.schema).parquet(path), seen

    (facts, seen), *dims = concurrently(wh.spark, sales, *[
        lambda d=d: dimension(*d) for d in (DIMENSIONS if dimensions else ())])
    customers, products, stores = dims or (None, None, None)
    return Staged(customers, products, stores, facts), seen


def extend_calendar(run: Run, calendar: DataFrame, seen: dict) -> Part | None:
    """The years of the staged sales that the published calendar lacks."""
    if "min_transaction_date" not in seen:
        return None
    span = calendar.agg(F.min("full_date"), F.max("full_date")).first()
    known = [d for d in span if d is not None]
    whole = dim_date(run.wh.spark, min([seen["min_transaction_date"], *known]),
                     max([seen["max_transaction_date"], *known]))
    lacking = whole
    if known:
        if seen["min_transaction_date"] >= known[0] and seen["max_transaction_date"] <= known[-1]:
            return None
        lacking = whole.filter((F.col("full_date") < F.lit(known[0]))
                               | (F.col("full_date") > F.lit(known[-1])))
    path = run.wh.table_path("dim_date", run.run_id)
    return Part("append", path, write_observed(lacking, path)["rows"])


def _write_dims(run: Run, dims, snap) -> dict[str, list[Part]]:
    """Write new current rows (replacing) and newly closed versions (appended).

    A dimension that the load left as it was keeps its published parts.
    """
    wh, rid = run.wh, run.run_id

    def written(table: str, kind: str, df: DataFrame, key: str, name: str) -> Part:
        path = wh.table_path(table, rid, name)
        got = write_observed(df, path, F.max(key).alias("top"))
        return Part(kind, path, got["rows"], got.get("top"))

    tasks, names = [], []
    for table, key in (("dim_customer", "customer_key"), ("dim_product", "product_key"),
                       ("dim_store", "store_key")):
        delta = dims.deltas[table]
        if not delta.changed and table in snap.parts:
            continue
        for kind, df, name in (("current", delta.current, "current"),
                               ("append", delta.closed, "closed")):
            # Stores close no version (SCD1).
            if table != "dim_store" or kind == "current":
                tasks.append(lambda a=(table, kind, df, key, name): written(*a))
                names.append(table)
    out: dict[str, list[Part]] = {}
    for table, part in zip(names, concurrently(wh.spark, *tasks)):
        out.setdefault(table, [])
        if part.kind == "current" or part.rows:
            out[table].append(part)
    return out


#: Rows of new facts that one range partition is meant to hold, and rows of a file of
#: the fact or of its keys: a file's min/max are what a reader can skip by.
FACT_ROWS, FILE_ROWS = 2_000_000, 1_000_000


def write_fact(run: Run, rows: DataFrame, after_key: int, staged_rows: int, settle=None
               ) -> tuple[list[Part], int]:
    """W09 + W25: the fact part and its conflict keys (none for no rows), and how many
    rows of the batch found all their dimensions.

    ``rows`` as by ``conflict_marked``, or made so by ``settle`` inside the range partitions.
    They are range-partitioned in (date, product, transaction) order and written once as
    columnar staging, tagged with their place, known keys last in their partition; the counts
    of the partitions turn places into dense keys as the rows are read back. The final files
    hold boxes of (date, product, store, customer) inside year_month folders
    (``operators.layout``).
    """
    wh, order = run.wh, [F.col(c) for c in SALES_KEY_ORDER]
    width = max(default_parallelism(wh.spark), -(-staged_rows // FACT_ROWS))
    ranged = rows.repartitionByRange(width, *order)
    tagged = ((settle(ranged) if settle else ranged).sortWithinPartitions("_known", *order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    staging = wh.staging_path(run.run_id, "fact")
    got = write_observed(
        tagged, staging, F.sum("_met").alias("met"), _count_if(~F.col("_known"), "new"),
        *[_count_if(~F.col("_known") & F.col(c).isNull(), c) for c in C.SALES_NOT_NULL],
        *[F.max(c).alias(f"top_{c}") for c in KEY_COLUMNS])
    nulls = {c: got[c] for c in C.SALES_NOT_NULL if got.get(c)}
    if nulls:
        raise ValueError(f"new facts with nulls in required columns: {nulls}")
    n, met = got.get("new", 0), got.get("met", 0)
    if n == 0:
        return [], met
    placed = wh.spark.read.schema(tagged.schema).parquet(staging).filter(~F.col("_known")).withColumns({
        "_pid": F.shiftright("_mid", 33), "year_month": year_month(F.col("transaction_date"))})
    # One row for each range partition reaches the driver.
    running, offsets = after_key + 1, []
    for r in sorted(placed.groupBy("_pid").count().collect(), key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], running))
        running += r["count"]
    numbered = placed.join(
        F.broadcast(wh.spark.createDataFrame(offsets, "_pid long, _first long")), "_pid")
    out = numbered.select(
        (F.col("_first") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).alias("sales_key"),
        *[c for c in C.FACT_COLUMNS if c != "sales_key"], "year_month",
        layout_order(F.col("date_key"), {c: got.get(f"top_{c}") for c in KEY_COLUMNS}).alias("_at"))
    path, keys_path = (wh.table_path(t, run.run_id) for t in ("fact_sales", "fact_keys"))
    place = ["year_month", "_at", "sales_key"]
    keys = placed.select("transaction_id", "product_key", "product_business_key", "year_month")
    concurrently(
        wh.spark,
        lambda: (out.repartitionByRange(width, *place).sortWithinPartitions(*place).drop("_at").write
                 .mode("errorifexists").option("maxRecordsPerFile", FILE_ROWS)
                 .partitionBy("year_month").parquet(path)),
        lambda: (keys.repartitionByRange(width, "transaction_id").sortWithinPartitions(
            "transaction_id").write.mode("errorifexists").option("maxRecordsPerFile", FILE_ROWS)
                 .parquet(keys_path)))
    return [Part("append", path, n, after_key + n), Part("append", keys_path, n)], met


#: Stretches of transactions that a batch is described by, and the counts they are found from.
RANGES, RANGE_BUCKETS = 64, 4096


def occupied(sales: DataFrame, low: int, high: int) -> list[tuple[int, int]]:
    """At most ``RANGES`` stretches that hold every transaction of a batch, without its widest gaps."""
    step = max(1, -(-(high - low + 1) // RANGE_BUCKETS))
    t = F.col("transaction_id")
    found = sorted(tuple(r) for r in sales.filter(t.isNotNull()).groupBy(
        F.floor((t - F.lit(low)) / F.lit(step)).alias("b")).agg(
        F.min(t).alias("lo"), F.max(t).alias("hi")).select("lo", "hi").collect())
    gaps = sorted(range(1, len(found)), key=lambda i: found[i - 1][1] - found[i][0])[:RANGES - 1]
    cuts = [0, *sorted(gaps), len(found)]
    return [(found[i][0], found[j - 1][1]) for i, j in zip(cuts, cuts[1:])]


def loaded_keys(wh: Warehouse, sales: DataFrame, seen: dict, mode: str) -> DataFrame | None:
    """Conflict keys already loaded, among the batch's transactions.

    The key table is sorted by transaction. The stretches of transactions that the batch holds
    reach its scan, which skips the files and row groups between them: a late sale
    in a batch of new ones costs the files around it and no more.
    """
    if not wh.snapshot().rows("fact_sales") or "min_transaction_id" not in seen:
        return None
    held = occupied(sales, seen["min_transaction_id"], seen["max_transaction_id"])
    near = reduce(lambda a, b: a | b, [F.col("transaction_id").between(*r) for r in held])
    return wh["fact_keys"].filter(near).select(*conflict_columns(mode))


def run_full_etl(wh: Warehouse, staged: Staged, as_of: dt.date, *, mode: str = "reference",
                 date_from: dt.date | None = None, date_to: dt.date | None = None,
                 kind: str = "full", dimensions: bool = True) -> int:
    """W20 (and W15 with a date range): dimensions, then facts, then publish.

    ``dimensions=False`` loads facts against the published dimensions (a feed
    whose dimensions did not change).
    """
    with observing(wh.spark):
        return _run_etl(wh, staged, as_of, mode, date_from, date_to, kind, dimensions)


def _run_etl(wh, staged, as_of, mode, date_from, date_to, kind, dimensions) -> int:
    step_name = "etl" if kind == "full" else "etl_incremental"
    run = Run(wh, kind)
    run.event(step_name, "INFO", f"{kind} ETL run started")
    step = "dimensions"
    t = time.perf_counter()
    try:
        snap = wh.snapshot(refresh=True)
        before = wh.tables()
        if date_from is not None and date_to is not None:
            staged = Staged(staged.customers, staged.products, staged.stores, staged.sales.filter(
                F.col("transaction_date").between(F.lit(date_from), F.lit(date_to))))
        staged, seen = materialize(run, staged, dimensions)
        t = _trace(run, "staging", t)
        changes: dict[str, list[Part]] = {}
        cal_part = extend_calendar(run, before["dim_date"], seen)
        if cal_part:
            changes["dim_date"] = [cal_part]
        if dimensions:
            dims = load_dimensions(before, staged, as_of, {
                name: snap.max_key(name) for name in ("dim_customer", "dim_product", "dim_store")})
            t = _trace(run, "dimension merges", t)
            run.events(dims.events)
            changes |= _write_dims(run, dims, snap)
            t = _trace(run, "dimension writes", t)
            run.event("dimensions", "INFO", C.MSG_DIMENSIONS)
        after = dict(before)
        for table, parts in changes.items():
            kept = [p.path for p in snap.parts.get(table, [])
                    if p.kind == "append" and table != "dim_store"]
            after[table] = wh.read_parts(table, [*kept, *[p.path for p in parts]])

        step = "fact_sales"
        dims = [after[d] for d in ("dim_date", "dim_store", "dim_customer", "dim_product")]
        known, settle = loaded_keys(wh, staged.sales, seen, mode), None
        if known is None:  # nothing loaded: duplicates are settled in the fact's order
            rows = resolve_for_order(staged.sales, *dims, mode)

            def settle(ranged: DataFrame) -> DataFrame:
                return dedupe_in_order(ranged, mode).withColumn("_known", F.lit(False))
        else:
            rows = conflict_marked(resolve_sales(staged.sales, *dims), known, mode)
        parts, met = write_fact(run, rows, snap.max_key("fact_sales"), seen["rows"], settle)
        t = _trace(run, "fact resolve + write", t)
        inserted = parts[0].rows if parts else 0
        run.metric(C.METRIC_FACT_INSERTED, inserted)
        run.metric(C.METRIC_FACT_TOTAL, snap.rows("fact_sales") + inserted)
        run.metric(C.METRIC_SALES_UNMATCHED, seen["rows"] - met)
        run.event("fact_sales", "INFO", C.MSG_FACT)
        if parts:
            changes["fact_sales"], changes["fact_keys"] = parts[:1], parts[1:]
        wh.publish(changes, replace={"dim_store"}, base=snap.version)
        t = _trace(run, "publish", t)
        run.event(step_name, "INFO", f"{kind} ETL run finished successfully")
        run.succeed()
        return run.run_id
    except Exception as exc:
        run.fail(exc, step)
        raise
    finally:
        wh.drop_staging(run.run_id)


def run_incremental_etl(wh: Warehouse, staged: Staged, date_from: dt.date, date_to: dt.date,
                        as_of: dt.date, mode: str = "reference") -> int:
    """Reload all dimensions, then only sales dated in [date_from, date_to]."""
    return run_full_etl(wh, staged, as_of, mode=mode, date_from=date_from, date_to=date_to,
                        kind="incremental")


_RUN = re.compile(r"/run=(\d+)")


def _run_of(path: str) -> int:
    return int(_RUN.search(path)[1])


def refresh_all_marts(wh: Warehouse, incremental: bool = True) -> int:
    """Refresh the three marts from the published snapshot, replace them, log.

    With ``incremental``, a mart that records which fact folders it covers is
    brought up to date from the folders added since (W21: affected months
    recomputed; W22: new sums added; W23: new pairs of store and customer); otherwise
    it is recomputed in full. The marts' jobs run beside each other.
    """
    with observing(wh.spark):
        return _refresh_marts(wh, incremental)


def _refresh_marts(wh: Warehouse, incremental: bool) -> int:
    run = Run(wh, "marts", C.MSG_MARTS_RUN)
    run.event("marts", "INFO", C.MSG_MARTS_RUN)
    try:
        snap = wh.snapshot(refresh=True)
        t = wh.tables()
        fact_paths = [p.path for p in snap.parts.get("fact_sales", [])]
        changes, replace, tasks = {}, set(), []

        def write(name: str, df: DataFrame) -> None:
            path = wh.table_path(name, run.run_id)
            changes[name] = [Part("current", path, write_observed(df, path)["rows"])]
            changes[f"{name}#covers"] = [
                Part("covers", path, max(map(_run_of, fact_paths), default=0))]
            replace.update((name, f"{name}#covers"))

        def write_stores(added: list[str] | None) -> None:
            """W23 from the pairs of store and customer: the facts added since extend them, and the
            stores' names, which are overwritten in place, are joined at the end."""
            facts = t["fact_sales"] if added is None else wh.read_parts("fact_sales", added)
            held = [] if added is None else [p.path for p in snap.parts[STORE_PAIRS]]
            path = wh.table_path(STORE_PAIRS, run.run_id)
            if added is None or added:
                got = write_observed(store_pairs(facts), path)
                changes[STORE_PAIRS] = [Part("append", path, got["rows"])]
                held.append(path)
                if added is None:
                    replace.add(STORE_PAIRS)
            write("mart_store_region", store_region_of(wh.read_parts(STORE_PAIRS, held), t["dim_store"]))

        for name, fn in MARTS.items():
            # Fact folders are added in the order of their runs: the last covered
            # run tells which are new.
            covered = max((p.rows for p in snap.parts.get(f"{name}#covers", [])), default=0)
            added = [p for p in fact_paths if _run_of(p) > covered]
            can_add = incremental and name in snap.parts and (
                name in INCREMENTAL or STORE_PAIRS in snap.parts)
            if can_add and not added and name in INCREMENTAL:
                run.event("marts", "INFO", f"{name} is up to date")
                continue
            if can_add:
                run.event("marts", "INFO", f"Refreshing {name} from {len(added)} new fact folders")
            else:
                run.event("marts", "INFO", f"Refreshing {name}")
            if name not in INCREMENTAL:
                tasks.append(lambda a=added if can_add else None: write_stores(a))
            elif can_add:
                tasks.append(lambda n=name, a=added: write(n, INCREMENTAL[n](
                    t, wh[n], wh.read_parts("fact_sales", a))))
            else:
                tasks.append(lambda n=name, f=fn: write(n, f(t)))
        concurrently(wh.spark, *tasks)
        if changes:
            wh.publish(changes, replace=replace, base=snap.version)
        run.event("marts", "INFO", C.MSG_MARTS_DONE)
        run.succeed()
        return run.run_id
    except Exception as exc:
        run.fail(exc, "marts")
        raise


def recent_runs(wh: Warehouse, n: int = 5) -> DataFrame:
    """The latest ``n`` runs with their last status (a top-k report)."""
    log = wh.read_log("etl_runs", S.ETL_RUNS)
    # Latest status row per run; on equal timestamps a final status beats RUNNING.
    per_run = log.groupBy("run_id").agg(
        F.min("at").alias("started_at"),
        F.max_by(F.struct("kind", "status", "error_message", "at"),
                 F.struct("at", (F.col("status") != "RUNNING").alias("_final"))).alias("_last"))
    return (per_run.select("run_id", "_last.kind", "_last.status", "_last.error_message",
                           "started_at",
                           F.when(F.col("_last.status") != "RUNNING", F.col("_last.at"))
                           .alias("ended_at"))
            .orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n))


def metrics(wh: Warehouse, run_id: int | None = None) -> DataFrame:
    """Load metrics, optionally of one run."""
    m = wh.read_log("etl_metrics", S.ETL_METRICS)
    return m if run_id is None else m.filter(F.col("run_id") == run_id)


def events(wh: Warehouse, run_id: int | None = None) -> DataFrame:
    e = wh.read_log("etl_events", S.ETL_EVENTS)
    return e if run_id is None else e.filter(F.col("run_id") == run_id)
