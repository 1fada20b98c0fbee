"""Language by the nearest of several centroids (operator 8).

A text is a vector of hashed byte trigrams of its letters: sublinear counts
times inverse document frequency, scaled to length 1. Each language has
``clusters`` centroids, found by cosine k-means. A text gets the language of
the centroid with the greatest cosine; it is ``rejected`` where that cosine
falls below nearly all of that language's own training texts.

Document frequencies are counted over every training row. The centroids are
fitted on at most ``max_per_language`` training rows of each language, those
with the least hash of their id: one task for a language holds no more.

Defined cases: a null text and a text without a letter are ``und`` with score
0; rows without a language are not learned from; with nothing to learn from
every text is ``und``; equal cosines go to the language first in order;
repeated rows and null ids are judged alike (a null id is not held out and
teaches nothing); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare

DIMENSIONS = 4096
#: Softness of the score: cosines are compared in steps of a twentieth.
SHARPNESS = 20.0
#: ASCII bytes that are not letters count as one space.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def counts(text: str) -> np.ndarray:
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b" "
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vectors(texts, idf: np.ndarray) -> np.ndarray:
    x = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, t in enumerate(texts):
        if t:
            x[i] = np.log1p(counts(t))
    x *= idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _document_counts(batches):
    total = np.zeros(DIMENSIONS + 1, np.int64)
    for b in batches:
        for t in b.column("text").to_pylist():
            if has_letter(t):
                total[:-1] += counts(t) > 0
                total[-1] += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1)), pa.array(total)],
                                     names=["dimension", "n"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Centroids of length 1; starts from texts far from those already chosen."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].sum(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


class Centroids:
    def __init__(self, idf: np.ndarray, langs: list[str], rows: np.ndarray, least: list[float]):
        self.idf, self.rows = idf, rows
        self.langs, self.least = langs, np.array(least)
        self.names = sorted(set(langs))
        self.owner = [np.array([i for i, x in enumerate(langs) if x == n]) for n in self.names]

    def predict(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        if known and self.names:
            cos = vectors([texts[i] for i in known], self.idf) @ self.rows.T
            best = np.stack([cos[:, o].max(axis=1) for o in self.owner], axis=1).astype(float)
            own = best.argmax(axis=1)
            top = best[np.arange(len(known)), own]
            soft = 1 / np.exp(SHARPNESS * (best - top[:, None])).sum(axis=1)
            for i, j, s, t in zip(known, own, soft, top):
                lang[i], score[i], rejected[i] = self.names[j], s, t < self.least[j]
        return lang, score, rejected


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, clusters: int = 4, max_per_language: int = 500) -> Centroids:
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    total = np.zeros(DIMENSIONS + 1)
    for r in (rows.select("text").mapInArrow(_document_counts, "dimension long, n long")
              .groupBy("dimension").agg(F.sum("n").alias("n")).collect()):
        total[r["dimension"]] = r["n"]
    idf = np.log((1 + total[-1]) / (1 + total[:-1])).astype(np.float32) + np.float32(0.05)
    # The rows of a language with the least hashes of their ids. A cut that leaves twice as many
    # comes first, so that what meets in one task does not grow with the language.
    share = rows.groupBy("lang").agg((F.lit(2.0 * max_per_language) / F.count(F.lit(1))).alias("share"))
    h = F.xxhash64("doc_id")
    low = rows.select("doc_id", "lang").join(F.broadcast(share), "lang").where(
        (h / F.lit(2.0 ** 64) + 0.5) < F.col("share")).select("lang", "doc_id").distinct()
    first = Window.partitionBy("lang").orderBy(h, "doc_id")
    sample = low.withColumn("k", F.row_number().over(first)).where(
        F.col("k") <= max_per_language).select("doc_id", F.col("lang").alias("taught"), "k")
    # At most max_per_language rows for each language: the texts need no shuffle.
    taught = rows.join(F.broadcast(sample), (rows["doc_id"] == sample["doc_id"])
                       & (rows["lang"] == sample["taught"]), "inner").select(
        "taught", "k", "text").dropDuplicates(["taught", "k"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        x = vectors([t for t in pdf["text"] if has_letter(t)], idf)
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        c = spherical_kmeans(x, clusters)
        least = float(np.quantile((x @ c.T).max(axis=1), 0.01))
        return pd.DataFrame({"lang": pdf["taught"].iloc[0], "least": least,
                             "centroid": [r.astype("<f4").tobytes() for r in c]})

    found = sorted(taught.groupBy("taught").applyInPandas(
        fit, "lang string, centroid binary, least double").collect(),
        key=lambda r: (r["lang"], r["centroid"]))
    mats = [np.frombuffer(r["centroid"], "<f4") for r in found]
    least = {r["lang"]: r["least"] for r in found}
    return Centroids(idf, [r["lang"] for r in found],
                     np.stack(mats) if mats else np.zeros((0, DIMENSIONS), np.float32),
                     [least[n] for n in sorted(least)])


def predict_column(model: Centroids, text: Column) -> Column:
    @F.arrow_udf("lang string, score double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        lang, score, rejected = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
            names=["lang", "score", "rejected"])
    return predict(text)


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row."""
    model = train(docs, **options)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       predict_column(model, F.col("text")).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.rejected").alias("rejected"))
