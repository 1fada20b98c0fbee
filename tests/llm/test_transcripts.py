"""Operator 5 against a plain Viterbi over whole conversations."""

import itertools

import numpy as np
import pytest

from starmart.llm import transcripts as H

DATA = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn int, role string, text string, part string, rendered string"


def plain_viterbi(model, steps):
    score, back = None, []
    for marked, _, codes in steps:
        e = model.emission(marked, codes)
        if score is None:
            score = model.start + e
        else:
            through = score[:, None] + model.move
            back.append(through.argmax(axis=0))
            score = through.max(axis=0) + e
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], float(score.max())


def path_score(model, steps, path):
    total, before = 0.0, None
    for (marked, _, codes), s in zip(steps, path):
        total += (model.start[s] if before is None else model.move[before, s]) + model.emission(marked, codes)[s]
        before = s
    return total


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    model = H.Model(["assistant", "system", "user"], rng.random(3), rng.random((3, 3)), rng.random((3, H.SEEN)))
    steps = [s for t in ("hi", "User: what?\nand", "- a\n- b\n" * 4, "x" * 300) for s in H.steps_of(t)]
    path, best = plain_viterbi(model, steps)
    every = [path_score(model, steps, p) for p in itertools.product(range(3), repeat=len(steps))]
    assert best == pytest.approx(max(every)) == pytest.approx(path_score(model, steps, path))


def test_markers_open_steps():
    text = "User: hello\nmore\nAssistant: hi\n### System\nrules\n<|user|> x\nA: y\nnot: a marker\nbot said"
    assert [(r, t) for r, t, _ in H.steps_of(text)] == [
        ("user", "hello\nmore"), ("assistant", "hi"), ("system", "\nrules"), ("user", "x"),
        ("assistant", "y\nnot: a marker\nbot said")]
    assert [(r, t) for r, t, _ in H.steps_of(None)] == [(None, "")] == [(r, t) for r, t, _ in H.steps_of("")]


def test_roles_of_the_given_conversations(spark):
    conv = spark.read.parquet(f"{DATA}/conversations.parquet")
    rows = H.parse_transcripts(conv).join(conv.withColumnRenamed("role", "true"), ["conv_id", "turn"]).collect()
    assert len(rows) == conv.count()
    assert sum(r["role"] == r["true"] for r in rows) > 0.95 * len(rows)
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") for r in rows)


def test_runs_that_cross_partitions(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, texts = [], ["ok?", "short", "a longer answer " * 20, "- list\n- list", "User: marked", "Bot: b\nUser: c"]
    for c, n in ((1, 3), (2, 400), (3, 1), (4, 30), (None, 5)):
        for t in range(n):
            rows.append((c, t, ["user", "assistant"][t % 2] if rng.random() < .8 else None,
                         str(rng.choice(texts)) + str(t), "x", "y"))
    rows += [(4, None, "user", None, "", ""), (4, 30, "system", "", "", "")]
    conv = spark.createDataFrame(rows, SCHEMA)
    models, real = [], H.fit
    monkeypatch.setattr(H, "fit", lambda x: models.append(real(x)) or models[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = H.parse_transcripts(conv)
        assert frame.rdd.getNumPartitions() > 1
        got = frame.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for c in (1, 2, 3, 4, None):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        steps = [(r[1], i, s) for r in mine for i, s in enumerate(H.steps_of(r[3]))]
        path, _ = plain_viterbi(models[0], [s for _, _, s in steps])
        want = [(t, i, models[0].roles[s], x[1]) for (t, i, x), s in zip(steps, path)]
        out = sorted(((r["turn"], r["part"], r["role"], r["text"]) for r in got if r["conv_id"] == c),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert out == want, c


def test_settled_paths_are_passed_on(monkeypatch):
    rng = np.random.default_rng(6)
    model = H.Model(["a", "b"], rng.random(2), rng.random((2, 2)), rng.random((2, H.SEEN)))
    texts = [str(x) for x in rng.choice(["x?", "y" * 50, "- z", "w" * 500], 300)]
    steps = [s for t in texts for s in H.steps_of(t)]
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pylist([{"conv_id": 1, "turn": i, "text": t} for i, t in chunk])
               for chunk in (list(enumerate(texts))[k:k + 10] for k in range(0, 300, 10))]
    monkeypatch.setattr(H, "HELD", 20)
    monkeypatch.setattr(H.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda s: 0})()))
    out = list(H._decode(model, {}, {}, (pa.int64(), pa.int64()))(iter(batches)))
    assert len(out) > 3
    roles = [r for b in out for r in b.column("role").to_pylist()]
    assert roles == [model.roles[s] for s in plain_viterbi(model, steps)[0]]


def test_every_cut_of_a_conversation_keeps_a_best_path():
    rng = np.random.default_rng(5)
    model = H.Model(["a", "b", "c"], rng.random(3), rng.random((3, 3)) ** 3, rng.random((3, H.SEEN)))
    rows = [{"conv_id": 1, "text": t} for t in rng.choice(["x?", "y" * 50, "- z\nq", "w" * 500], 24)]
    steps = [s for r in rows for s in H.steps_of(r["text"])]
    _, best = plain_viterbi(model, steps)
    for cuts in ([5], [1, 9], [3, 4, 20]):
        bounds = [0, *cuts, len(rows)]
        parts = [rows[i:j] for i, j in zip(bounds, bounds[1:])]
        edges = [{"pid": 2 * p, "i": 0, "conv": "1", "m": H.best_scores(model, None, part).ravel(),
                  "s": H._from_start(model, None, part)} for p, part in enumerate(parts)]
        before, at_end = H.chain(edges, 3)
        ends = [at_end[2 * p] for p in range(len(cuts))]
        assert ends == [before[2 * p + 2] for p in range(len(cuts))]
        total = edges[0]["s"][ends[0]]  # ties may be broken either way
        for e, a, b in zip(edges[1:], ends, [*ends[1:], None]):
            m = np.array(e["m"]).reshape(3, 3)[a]
            total += m.max() if b is None else m[b]
        assert total == pytest.approx(best)


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.parse_transcripts(empty).collect() == []
    none = spark.createDataFrame([(1, 0, None, "hi", "", ""), (1, 1, None, None, "", "")], SCHEMA)
    assert [(r["role"], r["text"]) for r in H.parse_transcripts(none).orderBy("turn").collect()] == [
        ("user", "hi"), ("user", "")]


def test_counts_do_not_depend_on_partitions(spark):
    rows = [(c, t, ["user", "assistant", None, "tool"][((c or 0) * 7 + t * t) % 4], f"line {t}?\n- b", None, None)
            for c in (None, 1, 2, 3) for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    order = ["conv_id", "turn"]
    models = [H.fit(df.repartitionByRange(n, *order).sortWithinPartitions(*order)) for n in (1, 3, 17)]
    for m in models[1:]:
        assert m.roles == models[0].roles
        assert np.allclose(m.start, models[0].start) and np.allclose(m.move, models[0].move)
        assert np.allclose(m.lines, models[0].lines)


def test_every_role_is_a_state(spark):
    rows = [(c, t, f"role{t}", f"word{t} " * (t + 1), None, None) for c in range(30) for t in range(20)]
    got = H.parse_transcripts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(H.fit(spark.createDataFrame(rows, SCHEMA).coalesce(1)).roles) == 20
    assert sum(r["role"] == f"role{r['turn']}" for r in got) > 0.9 * len(got)


def test_a_very_long_turn(spark):
    rows = [(1, 0, "user", "Hi?", None, None), (1, 1, "assistant", "yes.\n" * 60_000, None, None)]
    got = H.parse_transcripts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [len(r["text"]) for r in sorted(got, key=lambda r: r["turn"])] == [3, 300_000]
