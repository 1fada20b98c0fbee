"""Near-duplicates by circulant MinHash with exact verification (operator 2).

Two fixed permutations of ``SPACE`` positions make every signature. The first
scatters the hashed shingles; coordinate ``k`` is the least value of the second
one over those positions shifted by ``k``, so all coordinates of a shingle lie
side by side in one table. Coordinates are cut into bands; texts that share a
band are candidates; candidates are linked only after their whole shingle sets
have been compared.

Steps, each a Spark job over narrow rows:
1. shingle sets of whole texts give a size, a 128-bit name, band keys and two
   sketches; equal sets become one class, so copies are never paired;
2. each class is compared with the most central class of its bands (the one
   that meets most others), and the links give components;
3. bands that still hold several components have every other pair across
   components compared, unless sizes or sketches rule it out. Pairs inside a
   component are not needed: only reachability is asked for;
4. components are closed and every document takes the least id of its own.

A band misses a pair at the threshold with probability ``(1 - t**rows)**bands``:
9e-7 for 0.85 with 36 bands of 7 rows. Two sketches rule pairs out. The parity
sketch (for each of 1024 places, whether an odd number of shingles falls there)
is exact: two sets differ in at least as many shingles as their sketches differ
in places. The coordinates' low bits rule a pair out when it is six standard
deviations below the threshold.

Hot groups: classes and band minima are aggregated before the shuffle, and the
remaining joins are plain equi-joins that adaptive execution may split. No
bucket is gathered into one row or task, capped or sampled.

Defined cases: a text without words (or null) has the empty set and is linked
with nothing; a null id takes part in no link, and its component is null;
rows with one id belong to one component if their texts are equal; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, prepare, staged

#: Positions that the two permutations act on.
SPACE = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: Columns of the coordinates' low bits (256) and of the parity sketch (1024 places).
BITS, PARITY = [f"s{i}" for i in range(4)], [f"o{i}" for i in range(16)]
SKETCH = BITS + PARITY
FEATURES = "doc_id long, n_shingles long, name binary, bands array<long>, " + ", ".join(
    f"{c} long" for c in SKETCH)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _WordHashes()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``k``-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > 150_000:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    width = min(k, len(words))
    x = np.full(n, width, np.uint64)
    for i in range(width):
        x = mix(x * _ODD[i % len(_ODD)] + h[i:i + n])
    return np.unique(x)


def name_of(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


class Circulant:
    """Signatures of ``width`` coordinates from two permutations of ``SPACE``."""

    def __init__(self, width: int):
        rng = np.random.default_rng(20)
        self.scatter = rng.permutation(SPACE).astype(np.uint32)
        values = rng.permutation(SPACE).astype(np.uint32)
        self.shifted = sliding_window_view(np.append(values, values[:width - 1]), width)
        self.width = width

    def signature(self, found: np.ndarray) -> np.ndarray:
        at = self.scatter[(found & np.uint64(SPACE - 1)).astype(np.int64)]
        low = np.full(self.width, SPACE, np.uint32)
        for i in range(0, len(at), 1024):
            np.minimum(low, self.shifted[at[i:i + 1024]].min(axis=0), out=low)
        return low


_circulants: dict[int, Circulant] = {}


def circulant(width: int) -> Circulant:
    if width not in _circulants:
        _circulants[width] = Circulant(width)
    return _circulants[width]


def _features(k: int, bands: int, rows: int):
    def run(batches):
        made = circulant(bands * rows)
        band_no = np.arange(bands, dtype=np.uint64)
        for b in batches:
            sizes, names, keys, sketches = [], [], [], []
            for text in b.column("text").to_pylist():
                found = shingles(text, k)
                sizes.append(len(found))
                if not len(found):
                    names.append(None)
                    keys.append(None)
                    sketches.append([None] * len(SKETCH))
                    continue
                low = made.signature(found).astype(np.uint64)
                key = band_no.copy()
                for column in low.reshape(bands, rows).T:
                    key = mix(key * _ODD[0] + column)
                bits = np.resize((mix(low + _ODD[1]) & np.uint64(1)).astype(np.uint8), 256)
                names.append(name_of(found))
                keys.append(key.view(np.int64))
                odd = np.bincount((found >> np.uint64(40) & np.uint64(1023)).astype(np.int64),
                                  minlength=1024) & 1
                sketches.append(np.packbits(np.append(bits, odd.astype(np.uint8))).view(
                    np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))] +
                [pa.array([s[i] for s in sketches], pa.int64()) for i in range(len(SKETCH))],
                names=[c.split(" ")[0] for c in FEATURES.split(", ")])
        _words.clear()
        give_back()
    return run


def _verify(k: int, num: int, den: int):
    """Pairs whose whole sets have at least ``num / den`` in common."""
    def run(batches):
        kept: dict[bytes, np.ndarray] = {}

        def the_set(name, text):
            if name not in kept:
                if len(kept) >= 32:
                    kept.pop(next(iter(kept)))
                found = shingles(text, k)
                if name_of(found) != name:  # another text of a repeated id: its own row follows
                    return found[:0]
                kept[name] = found
            return kept[name]

        for b in batches:
            out = ([], [])
            for a, c, ta, tc in zip(*(b.column(x).to_pylist() for x in (
                    "a", "b", "text_a", "text_b"))):
                sa, sc = the_set(a, ta), the_set(c, tc)
                if len(sa) and len(sc):
                    both = len(np.intersect1d(sa, sc, assume_unique=True))
                    if den * both >= num * (len(sa) + len(sc) - both):
                        out[0].append(a)
                        out[1].append(c)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in out],
                                             names=["a", "b"])
        kept.clear()
        _words.clear()
        give_back()
    return run


def linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, num: int,
           den: int) -> DataFrame:
    """The pairs (a, b) of class names that pass on their whole texts."""
    who = classes.select("name", "doc_id")
    named = (pairs.join(who.toDF("a", "id_a"), "a").join(who.toDF("b", "id_b"), "b"))
    wanted = named.select(F.col("id_a").alias("doc_id")).union(
        named.select(F.col("id_b").alias("doc_id"))).distinct()
    needed = texts.join(wanted, "doc_id", "left_semi")
    return staged(
        named.join(needed.toDF("id_a", "text_a"), "id_a")
        .join(needed.toDF("id_b", "text_b"), "id_b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(k, num, den), "a binary, b binary"), "links").distinct()


def components(links: DataFrame) -> DataFrame:
    """(name, root) for every name in ``links`` by alternating large and small stars."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "u <> v").distinct()
    edges = staged(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = staged(small.select("u", F.col("m").alias("v")).union(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where(
                "u <> v").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("name"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("name"), F.col("v").alias("root")).distinct())


def _alike(num: int, den: int, coordinates: int):
    """Sizes and sketches that do not rule out the threshold; columns of sides x and y."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    sizes = den * F.least(x("n"), y("n")) >= num * F.greatest(x("n"), y("n"))
    differ = lambda cs: sum((F.bit_count(x(c).bitwiseXOR(y(c))) for c in cs), F.lit(0))
    # At the threshold the sets differ in (den - num) / (den + num) of their sizes' sum.
    parity = (den + num) * differ(PARITY) <= (den - num) * (x("n") + y("n"))
    # A bit differs with probability (1 - similarity) / 2; few coordinates repeat.
    p, n = (1 - num / den) / 2, min(256, coordinates)
    most = math.ceil(256 * (p + 6 * math.sqrt(p * (1 - p) / n)))
    return sizes & parity & (differ(BITS) <= most)


def link_documents(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                   bands: int = 48, rows: int = 6, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two rows are linked when their shingle sets share ``num / den`` of their union.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    features = staged(texts.mapInArrow(_features(k, bands, rows), FEATURES), "features")
    usable = features.where("name is not null and doc_id is not null")
    classes = staged(usable.groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"), *[F.first(s).alias(s) for s in SKETCH]), "classes")
    rows_of = classes.select(F.explode("bands").alias("key"), "name")
    shared = rows_of.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    members = staged(rows_of.join(shared, "key"), "members")
    alike = _alike(num, den, bands * rows)
    # How many others a class meets over its bands: the text that copies were
    # made from meets most, as each copy strays from it in bands of its own.
    narrow = staged(classes.select("name", "n", *SKETCH).join(
        members.groupBy("name").agg(F.sum("met").alias("met")), "name"), "narrow")
    rank = F.struct("met", "name")
    pivots = members.select("key", "name").join(narrow.select("name", "met"), "name").groupBy(
        "key").agg(F.max(rank).alias("pivot"))

    # One comparison for each class: with the most central class that may pass.
    stars = (members.select("key", "name").join(pivots, "key")
             .where("name <> pivot.name").select("name", "pivot").distinct().alias("p")
             .join(narrow.alias("x"), F.col("p.name") == F.col("x.name"))
             .join(narrow.alias("y"), F.col("p.pivot.name") == F.col("y.name")).where(alike)
             .groupBy(F.col("p.name").alias("a")).agg(F.max("p.pivot").alias("b"))
             .select("a", F.col("b.name").alias("b")))
    stars = staged(stars, "stars")
    links = linked(stars, classes, texts, k, num, den)
    roots = components(links)

    # Bands that still join several components: every other pair across them.
    placed = members.select("key", "name").join(roots, "name", "left").withColumn(
        "root", F.coalesce("root", "name"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    placed = staged(placed.join(open_keys.where("low <> high"), "key").join(narrow, "name"), "open")
    # One side leaves out the component of the band's least root: pairs inside
    # a component are not formed.
    rest = (placed.where("root <> low").alias("x").join(
        placed.alias("y"), (F.col("x.key") == F.col("y.key"))
        & (F.col("x.root") > F.col("y.root")) & alike)
        .select(F.greatest("x.name", "y.name").alias("a"),
                F.least("x.name", "y.name").alias("b")).distinct())
    rest = rest.join(stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
                     ["a", "b"], "left_anti")
    rest = staged(rest, "rest")
    if not rest.isEmpty():
        more = linked(rest, classes, texts, k, num, den)
        roots = components(links.union(more))

    grouped = classes.select("name", "doc_id").join(roots, "name", "left").withColumn(
        "root", F.coalesce("root", "name"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = grouped.join(least, "root").select("name", "component_id")
    return (features.select("doc_id", "n_shingles", "name").join(of_class, "name", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


#: A column name that no table is likely to have.
_ROW = "_near_duplicate_row"


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that stand for their components, with all their columns.

    Of each component the least id stays. In a table that repeats ids, or lacks some, an id
    names no text: its rows are numbered in the order of id (null last) and text, written
    once, and linked by number, so that every text that is like no other stays.
    """
    n = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    key = "doc_id"
    if n[0] != n[1]:
        order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
        key, docs = _ROW, staged(docs.repartitionByRange(*order).sortWithinPartitions(*order)
                                 .withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    found = link_documents(docs, id_col=key, **options)
    gone = staged(found.where("not kept").select(F.col("doc_id").alias(key)), "copies")
    return docs.join(gone, key, "left_anti").drop(_ROW)
