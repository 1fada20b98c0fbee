"""Conversation repair against a search over whole edit strings."""

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import repair
from starmart.llm.queries import op11_run_length_repair
from starmart.llm.repair import Repair, damaged

SCHEMA = "conv_id long, turn long, role string, text string, kind string, n int, low long"


def cheapest(rows):
    """(cost, edits, repaired) of the least edits, then the least string; rows of (role, fault)."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    full = {"u": "user", "a": "assistant"}
    best = [{0: (0, "", ()), 3: (0, "", ())}]

    def inserted(at):
        for _ in range(4):  # inserts before a row, or behind the last
            for s in range(4):
                to = {"u": 2, "a": 3}[step[s]]
                if to in at:
                    c, e, out = at[to]
                    new = (c + 2, "I" + e, ((full[step[s]], ""), *out))
                    if s not in at or new[:2] < at[s][:2]:
                        at[s] = new
        return at

    at = inserted(best[0])
    for role, text, fault in reversed(rows):
        now = {}
        for s in range(4):
            options = []
            if s in at:
                options.append((at[s][0] + 3, "D" + at[s][1], at[s][2]))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                to = {"u": 2, "a": 3}[step[s]]
                if to in at:
                    c, e, out = at[to]
                    options.append((c + 2 + extra, "R" + e, ((full[step[s]], text), *out)))
                kept = 1 if role[:1] == "s" and s == 0 else to if role[:1] == step[s] else None
                if kept in at:
                    c, e, out = at[kept]
                    options.append((c + extra, "K" + e, ((role, text), *out)))
            if options:
                now[s] = min(options, key=lambda o: o[:2])
        at = inserted(now)
    return at[0]


def expected(rows):
    """The contract's row for each conversation; rows of (conv, turn, role, text) before damage."""
    convs = {}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out = convs.setdefault(conv, [])
        out += [(turn, "user" if how == 4 else role, text)] * {0: 0, 3: 2}.get(how, 1)
    return {c: told(rs) for c, rs in convs.items()}


def told(rs):
    digest = lambda role, text: hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
    rs = sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], digest(*r[1:])))
    seen, faults = set(), []
    for _, role, text in rs:
        core = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else
                      "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rs if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rs, rs[1:])]
    cost, audit, out = cheapest([(r, t, f) for (_, r, t), f in zip(rs, faults)])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def check(spark, rows, parts):
    df = spark.createDataFrame([(*r, "x", 5, 1) for r in rows], SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rep = Repair(damaged(df), "copies")
        got = rep.digests().collect()
        spans = len(rep.runs)
        assert rep.repaired().count() == sum(
            sum(e in "KRI" for e in r["audit"]) for r in got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r["conv_id"]], r
    return spans


ROLES = ["user", "assistant", "system", "tool", "User", "", None]
WORDS = ["Yes.", "no", "Fine! ", "ok?\n", " ", "", None, "a.b", "Yes.", "x" * 40 + "1.", "x" * 40 + "2."]


def drawn(seed, convs, longest):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            rows.append((None if c == 3 else c, rng.choice([t, t, t, t, None, t + 1, t + 5]),
                         rng.choice(["user", "assistant"] * 4 + ROLES), rng.choice(WORDS + [f"Turn {t}."] * 8)))
    return rows + rows[:5]


def test_many_small_conversations(spark):
    check(spark, drawn(1, 150, 9), 3)


def test_conversations_over_many_partitions(spark):
    """A few long conversations, one with most rows: every partition edge is crossed."""
    rows = drawn(2, 3, 60) + [(7, t, "user" if t % 3 else "assistant", f"T{t}." if t % 5 else "cut")
                              for t in range(300)]
    assert check(spark, rows, 12) >= 1


def test_copies_of_one_row(spark):
    rows = [(1, None, None, None)] * 60 + [(2, 5, "user", "Hello.")] * 60 + [(2, 6, "assistant", "Yes.")]
    check(spark, rows, 4)


def test_own_rows_and_interface(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "y" * 200_000 + ".")]
    rep = Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    edits = rep.edits().orderBy("part", "step").collect()
    assert [(r["edit"], r["fault"], r["times"]) for r in edits] == [
        ("K", None, 1), ("D", "duplicate", 1), ("K", None, 1)]
    assert [len(r["text"]) for r in rep.repaired().orderBy("turn").collect()] == [3, 200_001]


def test_empty_table(spark):
    assert Repair(damaged(spark.createDataFrame([], SCHEMA)), "copies").digests().collect() == []


def test_registered_query(spark):
    from tests.conftest import SF001
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = op11_run_length_repair(spark, SF001)
    assert {r["conv_id"]: tuple(r)[1:] for r in got.collect()} == expected(rows)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                           "audit", "repaired_sha256"]


symbols = st.lists(st.tuples(st.sampled_from([0, 1, 2, 3]), st.sampled_from("suax"),
                             st.integers(1, 3)), max_size=12)


@settings(max_examples=400, deadline=None)
@given(symbols, st.integers(0, 12))
def test_runs_equal_the_search(records, cut):
    """Powers of runs, cut anywhere, give the edits of the search."""
    rows = []
    for kind, c, n in records:
        fault = ("blank", "duplicate", "truncated", None)[kind]
        rows += [(c, "t", fault)] + [(c, "t", "blank" if kind == 0 else "duplicate")] * (n - 1)
    coded = [(k, "suax".index(c), n) for k, c, n in records]
    parts = [repair.collapsed(coded[:cut]), repair.collapsed(coded[cut:])]
    v = repair.applied(repair.transition(parts[1]), repair.END)
    state, edits, matrix_cost = 0, "", repair.transition(parts[0])
    for runs, to_go in ((parts[0], v), (parts[1], repair.END)):
        walked = repair.walk(runs, to_go, state)
        for symbol, n in runs:
            for _ in range(n):
                if symbol == repair.GONE:
                    edits += "D"
                else:
                    made, state = next(walked)
                    edits += "".join(e for e, _ in made)
    edits += "".join(e for e, _ in repair.closing(state))
    cost, want, _ = cheapest(rows)
    assert edits == want
    whole = repair.product(repair.product(matrix_cost, repair.transition(parts[1])), repair.INSERTS)
    assert min(whole[0][f] for f in repair.FINAL) == cost


def test_powers():
    for s in range(9):
        assert repair.transition([[s, 13]]) == repair.transition([[s, 1]] * 13)
        assert list(repair.behind(s, 13, repair.END)) == repair.vectors([[s, 1]] * 13, repair.END)
