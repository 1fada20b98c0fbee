"""Operators 8 and 10: held-out accuracy on the given tables, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import language as L
from starmart.llm import toxicity as T

DATA = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, score string, predicted string"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    rows = got.select("lang", "lang_pred", "score").collect()
    assert len(rows) > 2000 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.98 * len(rows)


def test_language_of_awkward_rows(spark):
    en, de = "the house and the garden are here ", "das haus und der garten sind hier "
    rows = [(i, (en if i % 2 else de) * (1 + i % 5), "en" if i % 2 else "de", None, "p") for i in range(60)]
    rows += [(100, None, "en", "", ""), (101, "", "de", "", ""), (102, "123 !!", "en", "", ""),
             (None, en, "en", "", ""), (7, en * 3, "en", "", ""), (103, en * 30000, None, "", ""), (104, "x", None, "", "")]
    got = L.identify(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] in (100, 101, 102):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is None or r["doc_id"] == 103:
            assert r["lang_pred"] == "en" and (r["doc_id"] or not r["held_out"])
        elif r["doc_id"] < 60:
            assert r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de")


def test_language_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None, "", "")], SCHEMA)
    assert [r["lang_pred"] for r in L.identify(docs).collect()] == ["und"]
    assert L.identify(docs.limit(0)).collect() == []


def test_held_out_ids_teach_nothing(spark):
    rows = [(i, f"text {'a' if i % 2 else 'b'} {i}", "en", "", "") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = docs.withColumn("text", F.when(L.held_out(F.col("doc_id")), F.lit("zzz qqq")).otherwise(F.col("text")))
    a, b = L.train(docs), L.train(other)
    assert np.array_equal(a.idf, b.idf) and np.array_equal(a.rows, b.rows)


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hit > 0.85 * sum(r["toxic"] for r in rows)
    assert sum(r["predicted"] > r["toxic"] for r in rows) < 0.01 * len(rows)


def test_readings_of_a_clause():
    g = T.Grammar({"idiot": 4.0, "low": 2.0})
    plain, aimed, negated, quoted, threat, top = range(6)
    assert g.features("what an idiot. fine")[plain] == pytest.approx(np.log1p(4)) and g.features("x")[top] == 0
    assert g.features("you idiot")[aimed] > 0 and g.features("you idiot")[plain] == 0
    assert g.features("you are not an idiot")[negated] > 0
    assert g.features("not that; an idiot")[plain] > 0  # a clause ends the negation
    assert g.features("he said idiot")[quoted] > 0
    assert g.features("i kill you")[threat] > 0 and g.features("they burn. wood")[threat] > 0
    assert g.features("burn the wood")[threat] == 0
    assert g.features("lowei idiotic")[top] == 4.0
    assert g.features(None) == g.features("") == g.features("calm words") == [0.0] * 6


def test_the_longest_stem_stands_for_its_beginnings():
    found = {"mor": (4.0, 101), "moro": (4.1, 100), "moron": (4.1, 100), "moron$": (4.1, 98), "low": (3.0, 50),
             "lowei": (3.0, 20)}
    assert T.specific(found) == {"moron": 4.1, "moron$": 4.1, "low": 3.0, "lowei": 3.0}


def toy(spark, n=120):
    bad, good = "walks like a frumpo near the sea", "walks along the calm sea today"
    rows = [(i, (bad if i % 4 == 0 else good) + f" n{i}", "en", "", None) for i in range(n)]
    rows += [(None, bad, "", "", ""), (3, good, "", "", ""), (900, None, "", "", ""), (901, "", "", "", ""),
             (902, good * 20000 + bad, "", "", "")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(n)] + [(0, 1, 0), (None, 1, 1), (5, 1, None)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_of_awkward_rows(spark):
    docs, labels = toy(spark)
    got = T.score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        bad = r["doc_id"] in (None, 902) or (r["doc_id"] < 120 and r["doc_id"] % 4 == 0)
        assert r["predicted"] == int(bad), r
    kept = T.toxicity_filter(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = toy(spark)
    flipped = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.train(docs, labels), T.train(docs, flipped)
    assert a.grammar.stems == b.grammar.stems and np.array_equal(a.weights, b.weights)


@pytest.mark.parametrize("marks", [[], [(1, 1, 0)], [(1, 1, None)]])
def test_toxicity_without_toxic_labels(spark, marks):
    docs = spark.createDataFrame([(1, "some text", "", "", ""), (2, None, "", "", "")], SCHEMA)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in T.score_documents(docs, labels).collect()] == [0, 0]
    assert T.score_documents(docs.limit(0), labels).collect() == []


def test_composed_transducers_equal_their_parts():
    """Every path of five classes, in the product and in each transducer by itself."""
    import itertools

    from starmart.llm import toxicity as X
    parts = (X.negation, X.report, X.target)
    for path in itertools.product(range(X.INSULT + 1), repeat=5):
        at, alone = 0, (0, 0, 0)
        for c in path:
            at = X.ARCS[at][c]
            alone = (0, 0, 0) if c == X.BREAK else tuple(f(x, c) for f, x in zip(parts, alone))
            assert X.STATES[at] == alone
    assert len(X.STATES) == (X.REACH + 1) * 4


def test_readings_of_clauses():
    from starmart.llm import toxicity as X
    g = X.Grammar({"idiot$": 2.0})
    read = lambda t: [round(float(np.expm1(x)), 6) for x in g.features(t)[:5]]
    plain, aimed, negated, reported = ([2.0 * (i == k) for i in range(4)] + [0] for k in range(4))
    assert read("what an idiot") == plain and read("you idiot") == aimed
    for t in ("he isn't an idiot", "he isn’t an idiot", "he is not an idiot", "they aren't idiot"):
        assert read(t) == negated, t
    assert read('she said "idiot"') == reported and read("l'idiot") == plain
    assert read("i will kill you")[4] == 1 and read("i won't kill you")[4] == 0 == read("kill time")[4]


def test_features_against_a_reading_of_whole_clauses():
    """Each insult read by what stands around it in its clause."""
    import random

    from starmart.llm import toxicity as X
    rng, g = random.Random(3), X.Grammar({"idiot$": 1.0, "fool$": 3.0})
    words = ["idiot", "fool", "you", "not", "don't", "said", '"', "kill", "the", "day", ".", "!"]
    for _ in range(400):
        tokens = [rng.choice(words) for _ in range(rng.randrange(16))]
        sums, threats = [0.0] * 4, 0
        for clause in " ".join(tokens).replace("!", ".").split("."):
            ws = clause.split()
            near = lambda k: any(w in ("not", "don't") for w in ws[max(0, k - X.REACH):k])
            aimed = "you" in ws
            for k, w in enumerate(ws):
                if w in ("idiot", "fool"):
                    told = any(x in ("said", '"') for x in ws[:k])
                    sums[2 if near(k) else 3 if told else 1 if aimed else 0] += 1.0 if w == "idiot" else 3.0
                threats += w == "kill" and aimed and not near(k)
        got = g.features(" ".join(tokens))
        assert np.allclose(got[:5], np.log1p([*sums, threats]))
