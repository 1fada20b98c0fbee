"""Operator 2 against all pairs on small tables."""

import random
import re

import numpy as np
import pytest

from starmart.llm import minhash as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else (
        frozenset([tuple(w)]) if w else frozenset())


def brute(rows, k, num, den):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                both = len(a & b)
                if den * both >= num * len(a | b):
                    root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        c = d if d is None else min(ids)
        out.append((d, len(sets[i]), c, d == c))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(400)] + ["the", "of", "Ünï", "x"]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 30, 80, 200]))] for _ in range(40)]
    rows, passage = [], [rng.choice(words) for _ in range(40)]
    for b in base:
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append(" ".join(w) if rng.random() < .7 else "\n ".join(w).lower())
    for _ in range(20):  # a passage that many share
        rows.append(" ".join(passage + [rng.choice(words) for _ in range(rng.choice([3, 8, 40]))]))
    rows += [None, "", " \t", "one", "ONE", "two words", "Two  words", "a b c d"]
    rng.shuffle(rows)
    return [(i * 3 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,k,num,bands,rows_", [(1, 3, 85, 36, 7), (2, 5, 80, 48, 6)])
def test_components_against_all_pairs(spark, seed, k, num, bands, rows_):
    rows = corpus(seed)
    rows += [rows[4], rows[9], (None, rows[0][1]), (None, None)]  # repeated rows, null ids
    docs = spark.createDataFrame([(d, t, "n", "c", 1) for d, t in rows],
                                 "doc_id long, text string, name string, component_id string, n int")
    got = [tuple(r) for r in M.link_documents(docs.repartition(3), k, num, 100, bands, rows_).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute(rows, k, num, 100), key=key)
    left = M.one_of_each(docs, k=k, num=num, den=100, bands=bands, rows=rows_)
    assert left.columns == docs.columns
    want = sorted({r[2] for r in brute(rows, k, num, 100) if r[2] is not None})
    ids = [r["doc_id"] for r in left.collect()]
    # Of the two rows without an id one copies a text that has one.
    assert sorted(i for i in ids if i is not None) == want and ids.count(None) == 1


def test_repeated_ids_lose_no_text(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "abcde"}
    near = text["a"].replace("a29", "x")
    rows = [(1, text["a"]), (2, text["a"]), (2, text["b"]), (3, text["c"]), (3, text["d"]),
            (None, text["e"]), (None, near), (3, None), (4, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(4)
    left = sorted((str(r["doc_id"]), (r["text"] or "")[:2]) for r in M.one_of_each(docs).collect())
    assert left == sorted([("1", "a0"), ("2", "b0"), ("3", "c0"), ("3", "d0"), ("None", "e0"),
                           ("3", ""), ("4", "")])
    # A link of one of an id's texts does not depend on which of them comes first.
    pair = [(5, text["b"]), (5, text["a"]), (7, near), (8, text["c"])]
    for rows in (pair, pair[::-1]):
        found = M.link_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
        assert {(r["doc_id"], r["component_id"]) for r in found.collect()} >= {(7, 5), (8, 8)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert M.link_documents(docs).collect() == [] and M.one_of_each(docs).collect() == []


def test_coordinates_are_shifts_of_one_permutation():
    made = M.Circulant(32)
    found = np.array([5, 99, 123456789, 2**63], np.uint64)
    at = made.scatter[(found & np.uint64(M.SPACE - 1)).astype(int)].astype(int)
    values = made.shifted[:, 0]
    assert sorted(values.tolist()) == list(range(M.SPACE))
    want = [min(values[(i + k) % M.SPACE] for i in at) for k in range(32)]
    assert made.signature(found).tolist() == want


def test_coordinates_estimate_similarity():
    rng, made = np.random.default_rng(3), M.Circulant(252)
    error = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 300, np.uint64)
        b = np.append(a[:270], rng.integers(0, 2**63, 30, np.uint64))
        error.append((made.signature(a) == made.signature(b)).mean() - 270 / 330)
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.04


def test_chains_close_into_one_component(spark):
    names = [bytes([i // 256, i % 256]) for i in range(300)]
    links = spark.createDataFrame([(names[i], names[i + 1]) for i in range(199)] +
                                  [(names[200], names[i]) for i in range(201, 300)], "a binary, b binary")
    got = {bytes(r["name"]): bytes(r["root"]) for r in M.components(links).collect()}
    assert got == {n: names[0] if i < 200 else names[200] for i, n in enumerate(names)}
