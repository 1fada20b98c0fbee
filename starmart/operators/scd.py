"""Slowly changing dimension merges, set-based.

SCD2 rules (row-by-row semantics of the reference, made set-based):

* staged rows of one business key apply in ``_seq`` order; a row equal
  (null-safe, on the tracked attributes) to its predecessor is dropped, the
  first predecessor being the current version;
* the remaining chain c1..cm: with a current version v0, v0 closes at
  as_of - 1, c1..c(m-1) get [as_of, as_of - 1] (empty) and cm is open from
  as_of; without one, c1 starts at 1900-01-01 (and closes at as_of - 1 when
  m > 1), the rest as above;
* keys absent from staging are untouched (no delete detection).

When no business key repeats in the batch (one partial aggregate tells),
a staged row's predecessor is the current version: a plain equi-join on
the key, unique on both sides. Otherwise the predecessor is found by
numbering current + staged rows globally in (business key, current first,
_seq) order and joining each row to the row numbered one less. That
equi-join is on a unique number, so one business key with a third of all
staged rows is spread over many tasks; per-key facts (first / last kept
row, has a current version) are partial aggregates joined back on the key
(AQE splits a hot key there).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import lit_date
from .ranking import assign_keys, max_key, row_number_global


@dataclass
class DimDelta:
    """Result of one dimension merge.

    ``current``: all current rows after the merge (replaces the previous
    current set). ``closed``: versions closed by this merge (appended to the
    history). ``events``: one change-feed row per inserted / changed key.
    ``changed``: false when the merge left every row as it was.
    """

    current: DataFrame
    closed: DataFrame
    events: DataFrame
    changed: bool = True

    def all_versions(self, history: DataFrame | None = None) -> DataFrame:
        out = self.current.unionByName(self.closed)
        if history is not None:
            out = out.unionByName(history.select(*self.current.columns))
        return out


def _version_cols(key: str, bk: str, attrs: list[str]) -> list[str]:
    return [key, bk, *attrs, "valid_from", "valid_to", "is_current"]


def most_rows(*keys: DataFrame) -> list[int]:
    """The most rows of one key in each frame of keys, counted together."""
    both = reduce(DataFrame.unionByName, [
        k.select(F.lit(i).alias("_i"), F.col(k.columns[0]).alias("_k")) for i, k in enumerate(keys)])
    found = {r["_i"]: r["n"] for r in both.groupBy("_i", "_k").count().groupBy("_i").agg(
        F.max("count").alias("n")).collect()}
    return [found.get(i, 0) for i in range(len(keys))]


def scd2_merge(dim: DataFrame, staged: DataFrame, *, entity: str, key: str, bk: str,
               attrs: list[str], as_of: dt.date, seq: str = "_seq",
               after_key: int | None = None, most: int | None = None) -> DimDelta:
    """Merge a staged batch into an SCD2 dimension (all versions).

    ``after_key``: the dimension's largest key when the caller knows it (the
    catalog keeps it); otherwise it is read from ``dim``. ``most``: the most
    staged rows of one key, when known.
    """
    cols = _version_cols(key, bk, attrs)
    as_of_c = lit_date(as_of)
    closed_to = F.date_sub(as_of_c, 1)
    cur = dim.filter(F.col("is_current")).select(*cols)

    # Only current rows of keys present in the batch can be predecessors: a
    # daily delta numbers O(batch) rows, not the whole dimension.
    cur_in_batch = cur.join(staged.select(bk), bk, "left_semi")

    def differs_from(prefix: str):
        return reduce(lambda x, y: x | y,
                      [~F.col(a).eqNullSafe(F.col(f"{prefix}{a}")) for a in attrs])

    if most is None:
        most = most_rows(staged.select(bk))[0]
    if most <= 1:
        # One staged row per key: its predecessor is the current version, a
        # plain equi-join on the key (unique on both sides).
        prior = cur_in_batch.select(bk, *[F.col(a).alias(f"_p_{a}") for a in attrs],
                                    F.lit(True).alias("_has_cur"))
        rows = staged.select(bk, *attrs, F.col(seq).cast("long").alias("_seq")).join(
            prior, bk, "left")
        kept = (rows.filter(F.col("_has_cur").isNull() | differs_from("_p_"))
                .select(bk, *attrs, "_seq", F.coalesce("_has_cur", F.lit(False)).alias("_has_cur"),
                        F.lit(0).cast("long").alias("_rn")))
        chain = kept.withColumn("_first", F.col("_rn")).withColumn("_last", F.col("_rn"))
        order = [F.col(bk)]
    else:
        # A key repeats: number current + staged rows globally in (key, current
        # first, _seq) order and join each row to the one numbered before it.
        both = (cur_in_batch.select(bk, *attrs, F.lit(0).alias("_ord"),
                                    F.lit(None).cast("long").alias("_seq"))
                .unionByName(staged.select(bk, *attrs, F.lit(1).alias("_ord"),
                                           F.col(seq).cast("long").alias("_seq"))))
        numbered, _ = row_number_global(both, [F.col(bk), F.col("_ord"), F.col("_seq")], "_rn")
        prev = numbered.select((F.col("_rn") + 1).alias("_rn"), F.col(bk).alias("_p_bk"),
                               *[F.col(a).alias(f"_p_{a}") for a in attrs])
        rows = numbered.filter(F.col("_ord") == 1).join(prev, "_rn", "left")
        has_pred = F.col("_p_bk").isNotNull() & (F.col("_p_bk") == F.col(bk))
        kept = rows.filter(~has_pred | differs_from("_p_")).select("_rn", bk, *attrs, "_seq")
        per_key = (kept.groupBy(bk).agg(F.min("_rn").alias("_first"),
                                        F.max("_rn").alias("_last"))
                   .join(cur_in_batch.select(bk, F.lit(True).alias("_has_cur")), bk, "left")
                   .fillna(False, subset=["_has_cur"]))
        chain = kept.join(per_key, bk, "inner")
        order = [F.col("_rn")]
    is_first = F.col("_rn") == F.col("_first")
    is_last = F.col("_rn") == F.col("_last")
    inserted = is_first & ~F.col("_has_cur")
    versions = chain.select(
        "_rn", bk, *attrs, "_has_cur",
        F.when(inserted, lit_date(C.FIRST_VALID_FROM)).otherwise(as_of_c).alias("valid_from"),
        F.when(is_last, F.lit(None).cast("date")).otherwise(closed_to).alias("valid_to"),
        is_last.alias("is_current"),
        F.when(inserted, F.concat(F.lit(C.MSG_INSERTED[entity]), F.col(bk).cast("string")))
        .otherwise(F.concat(F.lit(C.MSG_SCD2_CHANGE), F.col(bk).cast("string"))).alias("_msg"),
    )
    start = max_key(dim, key) if after_key is None else after_key
    keyed, n_new = assign_keys(versions, order, key, start)

    # From the numbered rows, which are materialized: the merge is not run again.
    touched = keyed.filter(F.col("_has_cur")).select(bk).distinct()
    closing = (cur.join(touched, bk, "left_semi")
               .withColumn("valid_to", closed_to)
               .withColumn("is_current", F.lit(False)))
    untouched = cur.join(touched, bk, "left_anti")
    new_current = untouched.select(*cols).unionByName(
        keyed.filter(F.col("is_current")).select(*cols))
    new_closed = closing.select(*cols).unionByName(
        keyed.filter(~F.col("is_current")).select(*cols))
    events = keyed.select(F.lit(f"dim_{entity}").alias("step"), F.lit("INFO").alias("level"),
                          F.col("_msg").alias("message"))
    return DimDelta(new_current, new_closed, events, n_new > 0)


def scd1_merge(dim: DataFrame, staged: DataFrame, *, entity: str, key: str, bk: str,
               attrs: list[str], seq: str = "_seq", after_key: int | None = None) -> DimDelta:
    """Insert, or overwrite every attribute; the key never changes.

    Several staged rows of one key: the last by ``_seq`` wins (a partial
    ``max_by`` aggregate, so a hot key is reduced map-side). One event per
    staged row, even when nothing differs.
    """
    cols = [key, bk, *attrs]
    last = (staged.groupBy(bk)
            .agg(F.max_by(F.struct(*[F.col(a) for a in attrs]), F.col(seq)).alias("_s"))
            .select(bk, *[F.col(f"_s.{a}").alias(a) for a in attrs]))
    old = dim.select(*cols)
    staged_flag = last.select(bk, *attrs).withColumn("_staged", F.lit(True))
    j = old.alias("o").join(staged_flag.alias("n"), bk, "full_outer")
    in_staged = F.col("n._staged").isNotNull()
    rows = j.select(
        F.col(f"o.{key}").alias(key), F.col(bk),
        *[F.when(in_staged, F.col(f"n.{a}")).otherwise(F.col(f"o.{a}")).alias(a) for a in attrs])
    existing = rows.filter(F.col(key).isNotNull())
    fresh = rows.filter(F.col(key).isNull()).drop(key)
    start = max_key(dim, key) if after_key is None else after_key
    fresh_keyed, n_new = assign_keys(fresh, [F.col(bk)], key, start)
    differs = reduce(lambda x, y: x | y,
                     [~F.col(f"o.{a}").eqNullSafe(F.col(f"n.{a}")) for a in attrs])
    changed = n_new > 0 or not j.filter(in_staged & differs).isEmpty()
    events = staged.select(F.lit(f"dim_{entity}").alias("step"), F.lit("INFO").alias("level"),
                           F.concat(F.lit(C.MSG_STORE_UPSERT), F.col(bk).cast("string"))
                           .alias("message"))
    empty = dim.select(*cols).filter(F.lit(False))
    return DimDelta(existing.select(*cols).unionByName(fresh_keyed.select(*cols)), empty, events,
                    changed)
