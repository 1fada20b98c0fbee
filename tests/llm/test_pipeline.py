"""The pipeline on small tables, and what is registered."""

import random

import __spark_entry__ as E
import corpus_pipeline as C
from starmart.llm import oracle, queries


def write(spark, path, docs, labels, benchmark):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def corpus():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te") for b in ("ran", "dol", "fin", "gam")]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice("abcdefgh") for _ in range(n))
    item = text(30)
    rows, kind = {}, {}
    for i in range(200):
        rows[i], kind[i] = text(60), "clean"
    for i in range(200, 260):
        rows[i], kind[i] = f"{text(30)} frumpo {text(30)}", "toxic"
    for i in range(260, 300):
        rows[i], kind[i] = " ".join(f"{w}%%% |" for w in text(40).split()), "junk"
    for i in range(300, 310):
        rows[i], kind[i] = f"{text(20)} {item} {text(20)}", "leak"
    for i in range(310, 320):
        rows[i], kind[i] = rows[i - 310] + (" more" if i % 2 else ""), "copy"
    rows[320], kind[320], rows[321], kind[321] = "too short", "junk", None, "junk"
    labels = [(i, int(kind[i] != "junk"), int(kind[i] == "toxic")) for i in rows if i % 3 and i < 320]
    return rows, kind, labels, [(0, item)]


def test_each_stage_takes_out_its_own(spark, tmp_path):
    rows, kind, labels, benchmark = corpus()
    frame = spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or ""), "x") for i, t in rows.items()],
                                  "doc_id long, text string, lang string, source string, n_chars long, key string")
    path = write(spark, tmp_path / "t", frame.repartition(4), labels, benchmark)
    docs, gone = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in C.STAGES[:-1]:
        out = C.staged(stage(spark, docs, path), "test")
        assert out.columns == docs.columns
        before, after = ({r["doc_id"] for r in f.select("doc_id").collect()} for f in (docs, out))
        assert after <= before and len(after) == out.count()
        gone.append((name, {kind[i] for i in before - after}))
        docs = out
    assert gone == [("quality", {"junk"}), ("toxicity", {"toxic"}), ("near_duplicates", {"copy"}),
                    ("decontamination", {"leak"})]
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {i for i in rows if kind[i] == "clean"}
    packed = C.STAGES[-1][1](spark, docs, path)
    whole = C.run(spark, path)
    key = ["doc_id", "start", "length"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, packed.select(*key).collect()))
    assert {r["doc_id"] for r in whole.collect()} == {i for i in rows if kind[i] == "clean"}


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert C.run(spark, write(spark, tmp_path / "e", docs, [], [])).collect() == []


def test_what_is_registered():
    names = E.queries()
    assert set(queries.queries()) <= set(names) and names["pipeline"] is C.run
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert set(oracle.ORACLES) <= set(E.oracle_sql())


def test_workers_give_freed_memory_back():
    """Idle workers stay beside later stages: what a task has freed must not stay with them."""
    import re

    from starmart.llm.common import give_back

    def held():
        with open("/proc/self/status") as f:
            return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) // 1024

    blocks = [bytes(4000) for _ in range(40_000)]
    last, before = blocks[-1], held()  # keeps the heap's end in use
    del blocks
    give_back()
    assert held() < before - 80 and last
