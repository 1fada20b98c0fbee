"""Repair of conversation structure by a run-length DP (operator 11).

A sound conversation has role initials ``(s?(ua)+)?`` and no blank, repeated or (if it
can be helped) truncated turn. Edits keep a row (0), give it the role user or assistant
(2), delete it (3; a must for blank and repeated rows) or insert an empty row of either
role (2); a truncated row that stays adds 1. The cheapest edits are found, ties by the
least string of the edits' initials (D < I < K < R).

A row's symbol is its role's initial with its fault. Between rows the DP has four
states (nothing yet, after s, after u, after a); a symbol is a 4 x 4 min-plus
transition. Equal consecutive symbols are one run, advanced by the binary powers of its
transition, which are kept for all conversations. From the costs to go behind each
run, halving with the same powers gives those behind each row, and the first edit
in order that keeps the least cost is chosen, row by row.

Rows are sorted in range partitions by (conversation, turn, role, first 32 characters of
the text, digest), so a conversation may span tasks. A task gives the transition of its
first and last stretch (16 numbers); these are chained backwards on the driver to
the costs behind each stretch, a second pass gives the state each stretch leaves for
each state it is entered in, and the edits follow. Equal rows of a turn are one record with
a count before anything is sorted, and the deletions of its copies are one edit with ``times``.
A task holds the rows of one conversation of its own range, as Arrow data.

A row repeats an earlier one of its conversation if role and text are equal; the
earliest turn of each (role, text) that occurs at several turns is joined to the rows by digest.

Defined cases: a null role or text is one space; a null conversation is a conversation, null turns
stand first; rows of one turn follow by role and text; an empty role, or one of
another initial, cannot be kept; texts of any length are whole; a conversation
all of whose rows have no copies has one row without an edit; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import checkpoint_dir

from .common import SPACES, prepare

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
FAULTS = ("blank", "duplicate", "truncated")
FAR = 1 << 60
#: States: nothing yet, after s, after u, after a. Where user or assistant leads is fixed by the state.
STATES = range(4)
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
FINAL = (0, 3)
#: Symbols: initial (s, u, a, other) and truncated or not; rows that must go have one of their own.
INITIALS = "sua"
GONE = 8

Vector = tuple[int, int, int, int]


def led(state: int, initial: int) -> int | None:
    """The state after keeping a row of this initial, None where that is not allowed."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial in (1, 2):
        return NEXT[state] if (initial == 1) == (ROLE[state] == "user") else None
    return None


def edits_of(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row itself, in the order of their initials."""
    out = [(DELETE, COST[DELETE], state)]
    if symbol != GONE:
        initial, short = divmod(symbol, 2)
        if led(state, initial) is not None:
            out.append((KEEP, COST[KEEP] + short, led(state, initial)))
        out.append((REROLE, COST[REROLE] + short, NEXT[state]))
    return out


def product(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def applied(a, v: Vector) -> Vector:
    """``a`` before the costs to go ``v``, less the first state's."""
    out = [min(a[i][k] + v[k] for k in STATES) for i in STATES]
    return tuple(x - out[0] for x in out)


def _inserts():
    """Least cost of inserts alone from each state to each."""
    m = [[0 if i == j else FAR for j in STATES] for i in STATES]
    for i in STATES:
        m[i][NEXT[i]] = min(m[i][NEXT[i]], COST[INSERT])
    m = tuple(map(tuple, m))
    return product(m, product(m, product(m, m)))


INSERTS = _inserts()
UNIT = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)
#: Costs to go behind the last row: inserts to a final state.
END: Vector = tuple(min(INSERTS[i][f] for f in FINAL) - min(INSERTS[0][f] for f in FINAL)
                    for i in STATES)


@lru_cache(None)
def power(symbol: int, k: int):
    """The transition of ``2**k`` rows of a symbol, inserts before each among them."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    own = [[FAR] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, to in edits_of(symbol, state):
            own[state][to] = min(own[state][to], cost)
    return product(INSERTS, own)


@lru_cache(1 << 16)
def advanced(symbol: int, n: int, v: Vector) -> Vector:
    """Costs to go before ``n`` rows of a symbol, from those behind them."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            v = applied(power(symbol, k), v)
    return v


def transition(runs):
    """The transition of runs of symbols in a row."""
    m = UNIT
    for symbol, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                m = product(m, power(symbol, k))
    return m


@lru_cache(1 << 16)
def chosen(symbol: int, state: int, v: Vector) -> tuple[tuple[tuple[str, int], ...], int]:
    """The edits at a row ((edit, state before) each, inserts first) and the state after them."""
    out = []
    own = edits_of(symbol, state)
    ahead = [min(INSERTS[s][t] + c + v[to] for t in STATES for _, c, to in edits_of(symbol, t))
             for s in STATES]
    while True:
        options = sorted([*own, (INSERT, None, NEXT[state])])
        for edit, cost, to in options:
            rest = COST[INSERT] + ahead[to] if edit == INSERT else cost + v[to]
            if rest == ahead[state]:
                break
        out.append((edit, state))
        state = to
        if edit != INSERT:
            return tuple(out), state
        own = edits_of(symbol, state)


def closing(state: int) -> list[tuple[str, int]]:
    """The inserts behind the last row."""
    out = []
    while state not in FINAL:
        out.append((INSERT, state))
        state = NEXT[state]
    return out


def behind(symbol: int, n: int, v: Vector):
    """Costs to go behind each of ``n`` rows of a run, first to last."""
    if n == 1:
        yield v
    elif n:
        half = 1 << (n - 1).bit_length() - 1
        yield from behind(symbol, n - half, advanced(symbol, half, v))
        yield from behind(symbol, half, v)


def symbols(kind: int, initial: int, n: int) -> list[tuple[int, int]]:
    """A record's runs. ``kind``: 0 blank, 1 seen at an earlier turn, 2 truncated, 3 sound."""
    if not n:
        return []
    if kind < 2:
        return [(GONE, n)]
    return [(2 * initial + (kind == 2), 1)] + [(GONE, n - 1)] * (n > 1)


def collapsed(records) -> list[list[int]]:
    """Runs [symbol, rows] of (kind, initial, n) records, equal neighbours together."""
    runs: list[list[int]] = []
    for record in records:
        for symbol, n in symbols(*record):
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += n
            else:
                runs.append([symbol, n])
    return runs


def vectors(runs, v: Vector) -> list[Vector]:
    """Costs to go behind each run."""
    out = []
    for symbol, n in reversed(runs):
        out.append(v)
        v = advanced(symbol, n, v)
    return out[::-1]


def walk(runs, v: Vector, state: int):
    """(edits, state after them) of each row that need not go.

    Before a row that must go nothing is inserted, as D precedes I; it leaves the state.
    """
    for (symbol, n), after in zip(runs, vectors(runs, v)):
        if symbol == GONE:
            continue
        for v_row in behind(symbol, n, after):
            edits, state = chosen(symbol, state, v_row)
            yield edits, state


def left(runs, v: Vector, state: int) -> int:
    for _, state in walk(runs, v, state):
        pass
    return state


def _stretches(batches):
    """(conversation, its rows as Arrow batches) of a sorted partition."""
    conv, held = None, []
    for b in batches:
        ids, i = b.column("conv_id").to_pylist(), 0
        while i < len(ids):
            j = i
            while j < len(ids) and ids[j] == ids[i]:
                j += 1
            if held and ids[i] != conv:
                yield conv, held
                held = []
            conv = ids[i]
            held.append(b.slice(i, j - i))
            i = j
    if held:
        yield conv, held


def _records(held):
    for b in held:
        yield from zip(*(b.column(c).to_pylist() for c in ("kind", "initial", "n")))


def _ends(batches):
    """(place, conversation, rows) of a partition's first (0) and last (1) stretch."""
    last = None
    for i, (conv, held) in enumerate(_stretches(batches)):
        if not i:
            yield 0, conv, held
        else:
            last = conv, held
    if last:
        yield 1, *last


def _transitions(batches):
    pid = TaskContext.get().partitionId()
    for place, conv, held in _ends(batches):
        m = transition(collapsed(_records(held)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([pid], pa.int32()), pa.array([place], pa.int32()), pa.array([repr(conv)]),
             pa.array([[min(x, FAR) for row in m for x in row]], pa.list_(pa.int64()))],
            names=["pid", "place", "conv", "m"])


def _leaving(to_go: dict[tuple[int, int], Vector]):
    def run(batches):
        pid = TaskContext.get().partitionId()
        for place, _, held in _ends(batches):
            if (pid, place) in to_go:
                runs = collapsed(_records(held))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pid], pa.int32()), pa.array([place], pa.int32()),
                     pa.array([[left(runs, to_go[pid, place], s) for s in STATES]],
                              pa.list_(pa.int32()))], names=["pid", "place", "leaves"])
    return run


def crossings(ends) -> list[list[tuple[int, int, tuple]]]:
    """Stretches (partition, place, transition) of each conversation that spans partitions."""
    by: dict[int, dict[int, tuple]] = {}
    for e in ends:
        by.setdefault(e["pid"], {})[e["place"]] = e
    out: list[list] = []
    open_one: list = []
    for pid in sorted(by):
        first, last = by[pid][0], by[pid].get(1)
        if open_one and open_one[-1]["conv"] == first["conv"]:
            open_one.append(first)
        else:
            out.append(open_one)
            open_one = [first]
        if last:
            out.append(open_one)
            open_one = [last]
    out.append(open_one)
    return [[(e["pid"], e["place"], tuple(tuple(e["m"][4 * i:4 * i + 4]) for i in STATES))
             for e in run] for run in out if len(run) > 1]


def costs_behind(runs) -> dict[tuple[int, int], Vector]:
    out = {}
    for run in runs:
        v = END
        for pid, place, m in reversed(run):
            out[pid, place] = v
            v = applied(m, v)
    return out


def states_before(runs, leaves: dict[tuple[int, int], list[int]]) -> dict[tuple[int, int], int]:
    out = {}
    for run in runs:
        state = 0
        for pid, place, _ in run:
            out[pid, place] = state
            state = leaves[pid, place][state]
    return out


EDITS = ("conv_id {0}, part int, step long, turn {1}, edit string, fault string, times long, "
         "old_role string, role string, text string, crosses boolean")


def _edit(to_go, entered, final, across: bool | None):
    """The edits of every stretch; ``across``: only of conversations that do (not) span partitions."""
    def rows_of(held, runs, v, state, close):
        walked = walk(runs, v, state)
        for b in held:
            for turn, role, text, kind, initial, n in zip(*(b.column(c).to_pylist() for c in (
                    "turn", "role", "text", "kind", "initial", "n"))):
                for symbol, many in symbols(kind, initial, n):
                    if symbol == GONE:
                        yield (turn, DELETE, "blank" if kind == 0 else "duplicate", many,
                               role, None, text)
                        continue
                    edits, after = next(walked)
                    for edit, before in edits:
                        if edit == INSERT:
                            yield None, INSERT, None, 1, None, ROLE[before], ""
                        else:
                            yield (turn, edit, "truncated" if kind == 2 else None, 1, role, {
                                KEEP: role, REROLE: ROLE[before]}.get(edit), text)
                    state = after
        for _, before in closing(state) if close else ():
            yield None, INSERT, None, 1, None, ROLE[before], ""

    def run(batches):
        pid, step = TaskContext.get().partitionId(), 0
        ahead = None

        def emitted(place, held):
            nonlocal step
            at = (pid, place)
            crosses = at in to_go
            if across is not None and crosses != across:
                return
            runs = collapsed(_records(held))
            found = rows_of(held, runs, to_go.get(at, END), entered.get(at, 0),
                            not crosses or at in final)
            cols = list(zip(*found)) or [(None,), (None,), (None,), (0,), (None,), (None,), (None,)]
            n = len(cols[0])
            conv = held[0].column("conv_id").take(pa.array([0] * n))
            turns = pa.array(cols[0], held[0].schema.field("turn").type)
            yield pa.RecordBatch.from_arrays(
                [conv, pa.array([pid] * n, pa.int32()), pa.array(range(step, step + n), pa.int64()),
                 turns, *(pa.array(c, k) for c, k in zip(cols[1:], (
                     pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))),
                 pa.array([crosses] * n)],
                names=["conv_id", "part", "step", "turn", "edit", "fault", "times", "old_role",
                       "role", "text", "crosses"])
            step += n

        for i, (_, held) in enumerate(_stretches(batches)):
            if ahead is not None:
                yield from emitted(*ahead)
            # Places other than the first and the last never cross an edge.
            ahead = (0 if i == 0 else -1, held)
        if ahead is not None:
            yield from emitted(0 if ahead[0] == 0 else 1, ahead[1])
    return run


class Repair:
    """Sorted rows of the conversations, and what their edits need to know across partitions."""

    def __init__(self, conversations: DataFrame, copies: str | None = None):
        """``copies``: a column of how many times a row stands there, 0 included."""
        spark = conversations.sparkSession
        prepare(spark, batch_rows=1024)
        checkpoint_dir(spark)
        rows = conversations.select(
            "conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
            (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("n"))
        digest = F.unhex(F.md5(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text")))
        first = rows.where("n > 0").select("conv_id", "turn", digest.alias("digest")).groupBy(
            "conv_id", "digest").agg(
            F.min("turn").alias("low"), F.max("turn").alias("high"),
            F.max(F.col("turn").isNull()).alias("unnumbered")).where(
            "low < high or unnumbered and low is not null").select(
            F.col("conv_id").alias("c"), F.col("digest").alias("d"), "low", "unnumbered")
        records = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
        records = records.withColumn("digest", digest)
        seen = F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(
            F.col("turn") > F.col("low"))
        last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
        kind = (F.when(last == "", 0).when(F.coalesce(seen, F.lit(False)), 1)
                .when(~last.isin(".", "!", "?"), 2).otherwise(3))
        initial = F.substring("role", 1, 1)
        kinds = records.join(first, F.col("conv_id").eqNullSafe(F.col("c"))
                             & (F.col("digest") == F.col("d")), "left").select(
            "conv_id", "turn", "role", "text", "n", "digest", kind.alias("kind"),
            F.when(initial == "", 3).otherwise(F.coalesce(F.nullif(
                F.instr(F.lit(INITIALS), initial), F.lit(0)) - 1, F.lit(3))).alias("initial"))
        order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role",
                 F.substring("text", 1, 32), "digest"]
        # Frozen once: every pass needs the same partitions.
        self.rows = kinds.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", "turn", "kind", "initial", "n", "role", "text").checkpoint()
        narrow = self.rows.select("conv_id", "kind", "initial", "n")
        self.runs = crossings(narrow.mapInArrow(
            _transitions, "pid int, place int, conv string, m array<long>").collect())
        self.to_go = costs_behind(self.runs)
        found = narrow.mapInArrow(_leaving(self.to_go), "pid int, place int, leaves array<int>"
                                  ).collect() if self.to_go else []
        self.entered = states_before(self.runs, {(r["pid"], r["place"]): r["leaves"] for r in found})

    def edits(self, across: bool | None = None) -> DataFrame:
        """A row for each edit, in the order of (part, step) within a conversation."""
        kinds = [self.rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
        return self.rows.mapInArrow(
            _edit(self.to_go, self.entered, {run[-1][:2] for run in self.runs}, across),
            EDITS.format(*kinds))

    def repaired(self) -> DataFrame:
        """The rows of the repaired conversations."""
        return self.edits().where("edit <> 'D'").select("conv_id", "part", "step", "turn", "role", "text")

    def digests(self) -> DataFrame:
        """One row for each conversation: faults, cost, edits, hash of the repaired rows.

        A hash is read in order: conversations inside a partition are digested where they lie,
        the few that span partitions are brought together as a sorted stream.
        """
        kind = self.rows.schema["conv_id"].dataType.simpleString()
        inner = self.edits(across=False).mapInArrow(_digest, DIGEST.format(kind))
        outer = self.edits(across=True).repartition("conv_id").sortWithinPartitions(
            "conv_id", "part", "step").mapInArrow(_digest, DIGEST.format(kind))
        return inner.unionByName(outer)


DIGEST = ("conv_id {0}, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")


class _Sums:
    def __init__(self):
        self.low = self.high = self.turn = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.audit, self.hash, self.any = [], hashlib.sha256(), False

    def add(self, turn, edit, fault, times, old_role, role, text):
        if edit is None:
            return
        self.audit.append(edit * times)
        self.cost += COST[edit] * times + (fault == "truncated" and edit != DELETE)
        if edit != INSERT:
            initial = old_role[:1]
            self.illegal += times - 1
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
            if turn is not None and turn != self.turn:
                self.turns, self.turn, self.high = self.turns + 1, turn, turn
                self.low = turn if self.low is None else self.low
            if fault:
                self.faults[fault] += times
        if edit != DELETE:
            self.hash.update(b"\n" * self.any + f"{role}:{text}".encode())
            self.any = True

    def row(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit),
                self.hash.hexdigest())


def _digest(batches):
    conv, sums = None, None

    def out():
        long, text = pa.int64(), pa.string()
        return pa.RecordBatch.from_arrays(
            [conv, *(pa.array([x], k) for x, k in zip(sums.row(), (long,) * 6 + (text, text)))],
            names=["conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256"])

    for b in batches:
        ids = b.column("conv_id")
        cols = zip(*(b.column(c).to_pylist() for c in (
            "turn", "edit", "fault", "times", "old_role", "role", "text")))
        for i, (c, row) in enumerate(zip(ids.to_pylist(), cols)):
            if sums is None or c != conv[0].as_py():
                if sums is not None:
                    yield out()
                conv, sums = ids.slice(i, 1), _Sums()
            sums.add(*row)
    if sums is not None:
        yield out()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with a deterministic fifth of them damaged; ``copies`` is 0, 1 or 2.

    By crc32 of ``conv_id:turn`` modulo 20 (nulls are one space): 0 drops the row, 1 empties
    its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    how = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space)
                                     for c in ("conv_id", "turn"))).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(role).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))
