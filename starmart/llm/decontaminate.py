"""Benchmark decontamination by spaced seeds (operator 4), in SQL functions.

A mask picks some of the tokens under it and ignores the others. The seeds of
every benchmark item (a hash of the picked tokens at each offset) are joined
with the seeds of every document position. A hit lays the two texts side by
side, and every window of ``WINDOW`` tokens of that alignment is compared token
by token; it is a leak when at least 80 % of a window agree. The two masks leave
no such window out: any 13 tokens with at most two substitutions hold a seed of
one of them at some offset. A shorter item is one window; with the
``SHORT_MASKS`` of its length none of the substitutions its 80 % allow is left
out (one from five to nine tokens, two from ten on; an item of one to four tokens
must agree whole).

The benchmark is the small side: it is joined in blocks of at most
``BLOCK_TOKENS`` tokens, so what is broadcast has a bound whatever its size.
Hits are made distinct (document, item, alignment) before they are shuffled;
they are broadcast back to the texts only where their count allows it.

Defined cases: null and empty texts (and items) have no leak; a document that
holds an item several times is one row; a null id is reported as null, and
``drop_leaks`` tells the rows without an id apart by their texts' SHA-256; repeated rows count once; other columns are kept by ``drop_leaks`` and ignored
by ``find_leaks``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, staged

#: A 1 is a token that must agree, a 0 one that is ignored.
MASKS = ("1010011101", "111010011")
WINDOW, SHARE = 13, 0.8
#: The masks of items below ``WINDOW`` tokens, by length: beside ``MASKS``, the heaviest that
#: one or two masks allow (four of them for five tokens, where lighter ones are common pairs).
SHORT_MASKS = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("1111", "11101", "11011", "10111"), 6: ("1111", "11011"), 7: ("11011",),
               8: ("11111", "111011"), 9: ("111011",), 10: ("11111", "1100111"),
               11: ("111011",), 12: ("1110111",)}
#: Benchmark tokens in one broadcast block: with two masks, about 40 MB (four for short items).
BLOCK_TOKENS = 200_000
#: Most item tokens that the hits may carry to be broadcast, about 80 MB.
BROADCAST_TOKENS = 2_000_000
#: Most leaked documents whose ids are broadcast, about 16 MB.
BROADCAST_IDS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))),
                                F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def _seed(number: int, mask: str, t: Column, at: Column) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(t, at + i) for i, c in enumerate(mask) if c == "1"])


def _seeds(t: Column, at: Column, masks: dict[int, str]) -> Column:
    """(mask number, seed) of each mask that fits at position ``at``."""
    return F.array(*[F.struct(
        F.lit(n).alias("mask"),
        F.when(at + len(m) <= F.size(t), _seed(n, m, t, at)).alias("seed"))
        for n, m in masks.items()])


def _exploded(frame: DataFrame, masks: dict[int, str], *keep: str) -> DataFrame:
    at = frame.select(*keep, "t", F.posexplode("t").alias("at", "token"))
    return at.select(*keep, "t", "at", F.explode(_seeds(F.col("t"), F.col("at"), masks)).alias(
        "s")).where("s.seed is not null").select(*keep, "t", "at", "s.mask", "s.seed")


def _agreement(w: Column, q: Column, shift: Column) -> Column:
    """The most agreeing tokens of any window when ``q`` lies ``shift`` tokens into ``w``."""
    width = F.least(F.lit(WINDOW), F.size(q))
    first = F.greatest(F.lit(0), -shift)
    last = F.least(F.size(q), F.size(w) - shift)
    agree = F.transform(F.sequence(first, last - 1), lambda j: F.when(
        F.get(q, j) == F.get(w, shift + j), 1).otherwise(0))
    windows = let(agree, lambda a: F.transform(
        F.sequence(F.lit(1), last - first - width + 1),
        lambda i: F.aggregate(F.slice(a, i, width), F.lit(0), lambda x, y: x + y)))
    return F.when(last - first >= width, F.array_max(windows)).otherwise(0)


def _blocks(items: DataFrame) -> list[DataFrame]:
    total = items.agg(F.sum(F.size("q"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / BLOCK_TOKENS)) if total > BLOCK_TOKENS else 1
    return [items.where(F.pmod(F.xxhash64("item_id", "q"), F.lit(n)) == i) for i in range(n)]


def _alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc_id, item_id, shift) at which some seed of both agrees."""
    short = items.where(F.size("q") < WINDOW).select(F.size("q").alias("n")).distinct()
    lengths = {m: [n for n in SHORT_MASKS if m in SHORT_MASKS[n]]
               for n in sorted(r["n"] for r in short.collect()) for m in SHORT_MASKS[n]}
    masks = dict(enumerate([*MASKS, *lengths]))
    fits = reduce(Column.__or__, [(F.col("mask") == i) & F.size("t").isin(lengths[m])
                                  for i, m in masks.items() if m in lengths],
                  F.col("mask") < len(MASKS))
    places = _exploded(docs.select("doc_id", tokens(F.col("text")).alias("t")), masks, "doc_id")
    found = []
    for block in _blocks(items):
        seeds = (_exploded(block.withColumnRenamed("q", "t"), masks, "item_id")
                 .where(fits)
                 .select("item_id", F.col("at").alias("off"), "seed"))
        found.append(places.join(F.broadcast(seeds), "seed").select(
            "doc_id", "item_id", (F.col("at") - F.col("off")).alias("shift")))
    return staged(reduce(DataFrame.union, found).distinct(), "alignments")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, agreeing, window for each leaked item of a document."""
    items = staged(benchmark.select("item_id", tokens(F.col("text")).alias("q")).where(
        F.size("q") > 0).distinct(), "items")
    hits = _alignments(docs, items)
    hits = hits.join(items, "item_id").withColumnRenamed("doc_id", "hit_id")
    if (hits.agg(F.sum(F.size("q"))).first()[0] or 0) <= BROADCAST_TOKENS:
        hits = F.broadcast(hits)
    width = F.least(F.lit(WINDOW), F.size("q"))
    return (docs.select("doc_id", "text")
            .join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")))
            .select("doc_id", "item_id", width.alias("window"),
                    let(tokens(F.col("text")), lambda w: _agreement(
                        w, F.col("q"), F.col("shift"))).alias("agreeing"))
            .where(F.col("agreeing") >= F.ceil(F.col("window") * F.lit(SHARE)))
            .groupBy("doc_id", "item_id").agg(F.max("agreeing").alias("agreeing"),
                                              F.max("window").alias("window")))


def _without(docs: DataFrame, key: Column, benchmark: DataFrame) -> DataFrame:
    """The rows without a leak; ``key`` names their texts."""
    keyed = docs.select(key.alias("doc_id"), "text")
    leaks = staged(find_leaks(keyed, benchmark).select("doc_id").distinct(), "leaks")
    # Counted first: few ids spare the texts a shuffle, many are joined with one.
    few = leaks.count() <= BROADCAST_IDS
    leaks = leaks.withColumnRenamed("doc_id", "leak")
    return docs.join(F.broadcast(leaks) if few else leaks, key == leaks["leak"], "left_anti")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with all their columns."""
    null = F.col("doc_id").isNull()
    if not docs.where(null).head(1):
        return _without(docs, F.col("doc_id"), benchmark)
    return _without(docs.where(~null), F.col("doc_id"), benchmark).union(
        _without(docs.where(null), F.sha2("text", 256), benchmark))
