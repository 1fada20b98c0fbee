"""Quality rules and a hashed n-gram likelihood ratio (operator 6), in SQL functions.

Base rules count words, symbols, repeated lines and repeated 8-word windows.
The verdict compares two multinomials over hashed token uni- and bigrams: the
trusted target (documents labelled as good) and the raw corpus (all
documents). A document's score is the mean log-ratio of its grams, in units
of 2**-20, so sums are whole numbers and no order of rows changes a verdict.
The threshold lies below nearly all scores of trusted documents that the
target was not counted from.

The raw counts cover every document, the target and the threshold every
document labelled as good: the hash of an id says which of the two it serves.
Only the documents whose id may serve the target meet the labels with
their text, in one shuffled join; the threshold is found from narrow rows
of an id and a score, by counts of their values. The model has
``BUCKETS`` numbers at any size.

Defined cases: a null text has no words and fails; a document whose labels
disagree is not trusted; without a trusted document every log-ratio is 0 and
the base rules alone decide; repeated rows and null ids are judged alike;
other columns are kept by ``quality_filter`` and ignored by ``judge``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, staged

BUCKETS = 1 << 16
UNIT = 1 << 20
#: Tokens: runs of letters and digits, or runs of other visible characters.
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]+"
WINDOW = 8


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _repeat_words(w: Column) -> Column:
    """Words inside 8-word windows that occur twice or more."""
    def covered(pos: Column) -> Column:
        gaps = F.transform(pos, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(pos, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeated(rows: Column) -> Column:
        at = F.transform(rows, lambda r, k: F.when(
            (F.get(rows, k - 1)["h"] == r["h"]) | (F.get(rows, k + 1)["h"] == r["h"]), r["i"]))
        return F.array_sort(F.filter(at, lambda i: i.isNotNull()))

    def from_hashes(h: Column) -> Column:
        rows = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h),
                      let(let(rows, repeated), covered)).otherwise(F.lit(0).cast("long"))

    # Words are hashed once each; stretches of 2, 4 and 8 words from their two halves.
    def windows(h: Column, half: int = 1) -> Column:
        pairs = F.zip_with(h, F.slice(h, half + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))
        if 2 * half < WINDOW:
            return let(pairs, lambda longer: windows(longer, 2 * half))
        return let(F.slice(pairs, 1, F.size(h) - (WINDOW - 1)), from_hashes)

    return F.when(F.size(w) > WINDOW, let(
        F.transform(w, lambda x: F.xxhash64(x)), lambda h: windows(h))).otherwise(F.lit(0).cast("long"))


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: x.rlike(WORD))
    return F.struct(
        let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"))).alias("w"),
        F.regexp_count(plain, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias(
            "n_dup_lines"))


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")


def _pair(a: Column, b: Column) -> Column:
    """The hash of a bigram from its tokens' hashes; the last token's partner is 0."""
    return F.xxhash64(a, F.coalesce(b, F.lit(0).cast("long")))


def hashed_tokens(text: Column) -> Column:
    return F.transform(tokens(text), lambda x: F.xxhash64(x))


def _half(doc_id: Column) -> Column:
    """0 for ids that serve the target, 1 for the threshold's; null without an id."""
    return F.when(doc_id.isNotNull(), F.pmod(F.xxhash64(doc_id), F.lit(2)))


def _docs_half(labels: DataFrame) -> Column:
    """``_half`` of a document, whose id is hashed as the labels hold it."""
    return _half(F.col("doc_id").cast(labels.schema["doc_id"].dataType))


def trusted_ids(labels: DataFrame, half: int) -> DataFrame:
    """All ids of one half that are labelled as good without contradiction."""
    return labels.where(_half(F.col("doc_id")) == half).groupBy("doc_id").agg(
        F.min("quality").alias("q")).where("q = 1").select("doc_id")


def train(docs: DataFrame, labels: DataFrame, prior: float = 0.5) -> list[int]:
    """The log-ratio of each bucket in units of ``1 / UNIT``."""
    # The narrow side is hashed in each partition: texts are shuffled, but not sorted.
    good = trusted_ids(labels, 0).withColumn("good", F.lit(1).cast("long")).hint("shuffle_hash")
    texts, may_be = docs.select("doc_id", "text"), _docs_half(labels).eqNullSafe(F.lit(0))
    grams = (texts.where(may_be).join(good, "doc_id", "left").select("good", "text")
             .union(texts.where(~may_be).select(F.lit(None).cast("long").alias("good"), "text"))
             .select("good", hashed_tokens(F.col("text")).alias("h"))
             .select("good", "h", F.posexplode("h").alias("i", "a"))
             .select("good", F.explode(F.array(
                 _bucket(F.col("a")),
                 _bucket(_pair(F.col("a"), F.get(F.col("h"), F.col("i") + 1)))))
                 .alias("bucket")))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"),
                                         F.count("good").alias("target")).toArrow()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for b, n, k in zip(*(counts.column(c).to_pylist() for c in ("bucket", "raw", "target"))):
        raw[b], target[b] = n, k
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0] * BUCKETS
    norm = math.log((n_raw + prior * BUCKETS) / (n_target + prior * BUCKETS))
    return [round(UNIT * (math.log((t + prior) / (r + prior)) + norm))
            for t, r in zip(target, raw)]


#: A column name that no table is likely to have.
_WEIGHTS = "_quality_weights"


def with_weights(df: DataFrame, model: list[int]) -> DataFrame:
    """``df`` with the model beside each row: a scalar subquery of one row.

    Its value is read once and shared, and is no part of a plan's text.
    """
    row = df.sparkSession.createDataFrame([(model,)], "weights array<bigint>")
    return df.withColumn(_WEIGHTS, row.scalar())


def mean_ratio(text: Column) -> Column:
    """Mean log-ratio of a text's grams in units of ``1 / UNIT``; null without any."""
    w = F.col(_WEIGHTS)

    def total(h: Column) -> Column:
        gains = F.transform(h, lambda a, i: F.get(w, _bucket(a)) + F.get(
            w, _bucket(_pair(a, F.get(h, i + 1)))))
        return F.when(F.size(h) > 0, F.floor(F.aggregate(
            gains, F.lit(0).cast("long"), lambda x, y: x + y) / (2 * F.size(h))).cast("long"))

    return let(hashed_tokens(text), total)


#: Low bits of a score that the first pass over the scores leaves open. A score is a mean of
#: logarithms below 64, so a pass brings at most 32,768 counts to the driver at any size.
PASS_BITS = 12


def at_ranks(values: DataFrame, ranks: list[int]) -> list[int]:
    """The values ``s`` at these places (from 0) of the sorted column, by counts."""
    def place(counts, rank: int) -> tuple[int, int]:
        for r in sorted(counts, key=lambda r: r["at"]):
            if rank < r["n"]:
                return r["at"], rank
            rank -= r["n"]
        raise IndexError("no such rank")

    def counted(df: DataFrame, at: Column) -> list:
        return df.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()

    high = F.shiftright("s", PASS_BITS)
    coarse = counted(values, high)
    out = []
    for rank in ranks:
        bucket, inside = place(coarse, rank)
        out.append(place(counted(values.where(high == bucket), F.col("s")), inside)[0])
    return out


def lowered(low: int, middle: int) -> int:
    """The low quantile of the scores, half as far again from their median.

    Good documents rarer than the labelled ones stay above it.
    """
    return low - (middle - low) // 2


def threshold(scores: DataFrame, labels: DataFrame, quantile: float = 0.002) -> int:
    """From the scores (doc_id, s; written) of all held-out trusted documents."""
    held = staged(scores.where("s is not null").join(
        trusted_ids(labels, 1), "doc_id", "left_semi").select("s"), "held-out")
    n = held.count()
    return lowered(*at_ranks(held, [int(quantile * (n - 1)), n // 2])) if n else 0


def judge(docs: DataFrame, labels: DataFrame, **options) -> tuple[list[int], int]:
    """The model and the least score of a kept document."""
    model = train(docs, labels)
    held = docs.where(_docs_half(labels) == 1).select("doc_id", "text")
    scores = staged(with_weights(held, model).select(
        "doc_id", mean_ratio(F.col("text")).alias("s")), "scores")
    return model, threshold(scores, labels, **options)


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the base counts, base_failed, mean_ratio, threshold, kept for every row.

    Every text is counted and scored once, before the threshold is known.
    """
    counted = staged(with_weights(docs.select("doc_id", "text"), train(docs, labels)).select(
        "doc_id", base_counts(F.col("text")).alias("b"), mean_ratio(F.col("text")).alias("s")),
        "scores")
    least = threshold(counted.select("doc_id", "s"), labels, **options)
    n, rep = F.col("b.w.n_words"), F.col("b.w.n_repeat_words")
    failed = (n < 20) | (100 * rep > 30 * n)
    return counted.select(
        "doc_id", n.alias("n_words"), F.col("b.w.word_chars").alias("word_chars"),
        F.col("b.n_symbols").alias("n_symbols"), F.col("b.n_dup_lines").alias("n_dup_lines"),
        rep.alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & F.coalesce(F.col("s") >= least, F.lit(False))).alias("kept"),
        (F.col("s") / UNIT).alias("mean_ratio"), F.lit(least / UNIT).alias("threshold"))


def quality_filter(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    model, least = judge(docs, labels, **options)
    # Bound once: a filter would evaluate the counts again for each field it reads.
    sound = let(base_counts(F.col("text"))["w"], lambda w: (w["n_words"] >= 20)
                & (100 * w["n_repeat_words"] <= 30 * w["n_words"]))
    return with_weights(docs, model).where(
        sound & F.coalesce(mean_ratio(F.col("text")) >= least, F.lit(False))).drop(_WEIGHTS)
