"""Operator 6: base counts and the ratio against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from starmart.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\W]+|[^\s\w]+")
TEXTS = [None, "", "   \n\t ", "one", "a b c\x0bd\x0ce\rf", "x " * 8, "x " * 9, "a b c d e f g h " * 3,
         "l1 w\n\nl1 w\nl2\n l1 w\nl2\n\n", "# * $ % & | < > é ß 😀 #*", "a b c d e f g h i a b c d e f g h j",
         "w" * 5000, " ".join(f"v{i}" for i in range(3000)) + " " + " ".join(f"v{i}" for i in range(40)),
         "good words here " + " ".join(f"t{i}" for i in range(30))]


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    many = Counter(windows)
    inside = {i + j for i, x in enumerate(windows) if many[x] > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside))


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def grams(text):
    t = TOKEN.findall((text or "").lower())
    h = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in t]
    out = []
    for i, x in enumerate(h):
        y = h[i + 1] if i + 1 < len(h) else 0
        # Spark hashes a long as its 8 bytes, the next column seeded by the last hash.
        first = xxhash.xxh64_intdigest((x % (1 << 64)).to_bytes(8, "little"), 42)
        pair = xxhash.xxh64_intdigest((y % (1 << 64)).to_bytes(8, "little"), first)
        out += [x % Q.BUCKETS, signed(pair) % Q.BUCKETS]
    return out


def frames(spark, rows, marks):
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, b string").repartition(3)
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_base_counts(spark):
    docs, _ = frames(spark, [(i, t, "x", "y") for i, t in enumerate(TEXTS)], [])
    got = {r["doc_id"]: (r["b"]["w"]["n_words"], r["b"]["w"]["word_chars"], r["b"]["n_symbols"],
                         r["b"]["n_dup_lines"], r["b"]["w"]["n_repeat_words"])
           for r in docs.select("doc_id", Q.base_counts(F.col("text")).alias("b")).collect()}
    assert got == {i: base(t) for i, t in enumerate(TEXTS)}


def test_ratio_against_plain_python(spark):
    clean = [f"the good text number w{i} says w{i * 7 % 40} and w{i * 3 % 50} " * 2 +
             " ".join(f"z{(i * j) % 97}" for j in range(25)) for i in range(60)]
    junk = [" ".join(f"q{i * j % 31}%%% |" for j in range(1, 30)) for i in range(20)]
    rows = [(i, t, "x", None) for i, t in enumerate(clean + junk)] + [(None, clean[0], "", ""), (3, clean[3], "", "")]
    marks = [(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(60, 70)] + [(5, 0, 0), (None, 1, 0)]
    docs, labels = frames(spark, rows, marks)
    good = {i for i in range(40) if i != 5}
    halves = {r[0]: r[1] for r in spark.range(40).select("id", F.pmod(F.xxhash64("id"), F.lit(2))).collect()}
    raw, target = Counter(), Counter()
    for d, t, *_ in rows:
        raw.update(grams(t))
        if d in good and halves[d] == 0:
            target.update(grams(t))
    norm = math.log((sum(raw.values()) + .5 * Q.BUCKETS) / (sum(target.values()) + .5 * Q.BUCKETS))
    model = [round(Q.UNIT * (math.log((target[b] + .5) / (raw[b] + .5)) + norm)) for b in range(Q.BUCKETS)]
    assert Q.train(docs, labels) == model
    score = lambda t: math.floor(sum(model[b] for b in grams(t)) / len(grams(t)))
    held = sorted(score(t) for d, t, *_ in rows if d in good and halves[d] == 1)
    low, middle = held[int(0.002 * (len(held) - 1))], held[len(held) // 2]
    least = low - (middle - low) // 2
    got = Q.score_documents(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        text = (clean + junk)[r["doc_id"] if r["doc_id"] is not None else 0]
        n, _, _, _, rep = base(text)
        failed = n < 20 or 100 * rep > 30 * n
        assert r["base_failed"] == failed and r["kept"] == (not failed and score(text) >= least)
        assert r["mean_ratio"] == score(text) / Q.UNIT
    kept = Q.quality_filter(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert not [r for r in got if r["kept"] and (r["doc_id"] or 0) >= 60]


@pytest.mark.parametrize("marks", [[], [(1, None, None)]])
def test_no_trusted_documents(spark, marks):
    docs, labels = frames(spark, [(1, " ".join(f"w{i}" for i in range(25)), "", ""), (2, None, "", "")], marks)
    assert [(r["doc_id"], r["kept"]) for r in Q.score_documents(docs, labels).orderBy("doc_id").collect()] == [
        (1, True), (2, False)]


def test_empty_table(spark):
    docs, labels = frames(spark, [], [])
    assert Q.score_documents(docs, labels).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.range(5).selectExpr("id as doc_id", "'a b c' as text")
    labels = spark.range(5).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    plan = Q.score_documents(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "Exchange") if x in plan]


def test_every_trusted_document_counts(spark):
    """More labelled documents than any cap held: the last one by hash is still learned from."""
    n = 120_000
    last = spark.range(n).selectExpr("id", "xxhash64(id) as h").where("pmod(h, 2) = 0").orderBy(F.desc("h")).first()["id"]
    docs = spark.range(n).selectExpr("id as doc_id", f"if(id = {last}, 'zebra', 'ant') as text")
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert Q.trusted_ids(labels, 0).count() + Q.trusted_ids(labels, 1).count() == n
    model = Q.train(docs, labels)
    # Once in the corpus and once in the target weighs as much as in neither; else it weighs less.
    assert model[grams("zebra")[0]] == model[grams("zebu")[0]]


def test_ranks_by_counts(spark):
    rng = random.Random(6)
    values = [rng.randrange(-60 << 20, 5 << 20) for _ in range(300)] + [7, 7, 7, -1, 0, 4096, 4095]
    frame = spark.createDataFrame([(v,) for v in values], "s long").repartition(3)
    ranks = [0, 3, 150, 153, len(values) - 1]
    assert Q.at_ranks(frame, ranks) == [sorted(values)[k] for k in ranks]
