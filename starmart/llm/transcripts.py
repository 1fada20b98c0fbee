"""Roles of transcripts by a hidden Markov model, and canonical turns (operator 5).

The states are the roles. A step is a turn, or a part of a turn that begins
with a speaker marker of its own ("User:", "### Assistant", "<|system|>" ...). Its
lines give the observations: the marker, and for each line whether it asks, how
long it is and whether it is a list or code. Starts, transitions and line
features are counted over every row whose role is known; the role is never an
input of the parse. Viterbi's best path names each step's role, and the step is
rendered as ``<|role|>``, its text without the marker, ``<|end|>``.

Rows are sorted by (conversation, turn, text) in range partitions, so a
conversation may span tasks and one of any length is never held whole. A task
reports its first and last run of steps as matrices of best scores between
entry and exit role; these few numbers for each partition are chained on the
driver, and give every task the role before its first and after its last row.

Defined cases: a null or empty text is a turn of one empty line; rows without
a role are parsed and not counted; a null conversation id is one conversation
of its own; turns of one number follow in the order of their texts, repeated
rows side by side; with no known role at all every step is "user"; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import checkpoint_dir

from .common import prepare

#: How far a marker is trusted.
TRUST = 0.98
#: Steps held before the part of the path that is settled is passed on.
HELD = 2048
CODES = 2 * 4 * 3
#: Step shapes: how many lines and, on a log scale, how many characters.
SHAPES = 5 * 16
SEEN = CODES + SHAPES
# Speaker markers of common transcript styles and the role each names.
MARKERS = {"user": "user", "human": "user", "customer": "user", "question": "user", "q": "user",
           "assistant": "assistant", "ai": "assistant", "bot": "assistant", "agent": "assistant",
           "model": "assistant", "answer": "assistant", "a": "assistant",
           "system": "system", "instruction": "system", "instructions": "system"}
_NAMES = "|".join(sorted(MARKERS, key=len, reverse=True))
_MARKER = re.compile(
    rf"^\s*(?:(?:\*\*|#+\s*)?({_NAMES})(?:\*\*)?\s*:(?:\*\*)?\s*|#{{2,}}\s*({_NAMES})\s*$|"
    rf"<\|?({_NAMES})\|?>\s*|\[({_NAMES})\]\s*)", re.I)
_KIND = re.compile(r"^\s*(?:(?:[-*•]|\d+[.)])\s|(```|    |\t|[{}<]))")
OUT = "conv_id {0}, turn {1}, part int, role string, text string, rendered string"


def code_of(line: str) -> int:
    m = _KIND.match(line)
    kind = 0 if not m else 2 if m[1] else 1
    size = int(np.searchsorted((40, 120, 400), len(line)))
    return (int(line.rstrip().endswith("?")) * 4 + size) * 3 + kind


def steps_of(text: str | None) -> list[tuple[str | None, str, np.ndarray]]:
    """(marked role, text without the marker, line codes and shape) of each step of a turn."""
    steps: list[list] = []
    for line in (text or "").split("\n"):
        m = _MARKER.match(line)
        if m or not steps:
            role = MARKERS[next(g for g in m.groups() if g).lower()] if m else None
            steps.append([role, []])
            line = line[m.end():] if m else line
        steps[-1][1].append(line)
    out = []
    for role, lines in steps:
        seen = np.bincount([code_of(x) for x in lines], minlength=SEEN)
        size = min(15, int(1.25 * np.log2(1 + sum(map(len, lines)))))
        seen[CODES + 16 * min(4, len(lines) - 1) + size] = 1
        out.append((role, "\n".join(lines), seen))
    return out


class Model:
    """Log-probabilities of starts, transitions and line codes."""

    def __init__(self, roles: list[str], start: np.ndarray, move: np.ndarray, lines: np.ndarray):
        self.roles = roles
        norm = lambda x: np.log((x + 0.1) / (x + 0.1).sum(axis=-1, keepdims=True))
        self.start, self.move = norm(start), norm(move)
        self.lines = np.hstack([norm(lines[:, :CODES]), norm(lines[:, CODES:])])

    def emission(self, marked: str | None, codes: np.ndarray) -> np.ndarray:
        e = self.lines @ codes
        if marked in self.roles and len(self.roles) > 1:
            named = np.array([r == marked for r in self.roles])
            e = e + np.where(named, np.log(TRUST), np.log((1 - TRUST) / (len(self.roles) - 1)))
        return e


def _runs(batches):
    """(conversation, its rows) of a sorted partition, a batch's rows at a time.

    A conversation that goes on in the next batch comes in several pieces.
    """
    for b in batches:
        rows, i = b.to_pylist(), 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j]["conv_id"] == rows[i]["conv_id"]:
                j += 1
            yield rows[i]["conv_id"], rows[i:j]
            i = j


def _count(roles: list[str]):
    """Sums of a partition; and its first and last conversation with the roles at its edges.

    Whether a partition's first row starts its conversation only the row before it tells.
    """
    def run(batches):
        n = len(roles)
        at = {r: i for i, r in enumerate(roles)}
        start, move, lines = np.zeros(n), np.zeros((n, n)), np.zeros((n, SEEN))
        conv, before, edge = None, None, None
        for c, rows in _runs(batches):
            first = edge is not None and c != conv
            if edge is None:
                edge = c, at.get(rows[0]["role"])
            if c != conv:
                conv, before = c, None
            for r in rows:
                s = at.get(r["role"])
                if s is not None:
                    for marked, _, codes in steps_of(r["text"]):
                        if marked is None:
                            lines[s] += codes
                    if before is not None:
                        move[before, s] += 1
                    elif first:
                        start[s] += 1
                before, first = s, False
        if edge is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([np.concatenate([start, move.ravel(), lines.ravel()])], pa.list_(pa.float64())),
                 pa.array([repr(edge[0])]), pa.array([edge[1]], pa.int32()),
                 pa.array([repr(conv)]), pa.array([before], pa.int32())],
                names=["pid", "x", "first", "enters", "last", "leaves"])
    return run


COUNTS = "pid int, x array<double>, first string, enters int, last string, leaves int"


def fit(rows: DataFrame) -> Model:
    """Counts over all rows; every role that occurs is a state."""
    found = rows.where("role is not null").select("role").distinct().collect()
    roles = sorted(r["role"] for r in found) or ["user"]
    n = len(roles)
    # One row of some hundred numbers for each partition.
    total, before = np.zeros(n + n * n + n * SEEN), None
    for r in sorted(rows.mapInArrow(_count(roles), COUNTS).collect(), key=lambda r: r["pid"]):
        total += np.array(r["x"])
        if r["enters"] is not None:
            if before is None or before["last"] != r["first"]:
                total[r["enters"]] += 1
            elif before["leaves"] is not None:
                total[n + before["leaves"] * n + r["enters"]] += 1
        before = r
    return Model(roles, total[:n], total[n:n + n * n].reshape(n, n),
                 total[n + n * n:].reshape(n, SEEN))


def best_scores(model: Model, into: np.ndarray | None, rows: list[dict]) -> np.ndarray:
    """Best score from each entry role (rows) to each role after these turns."""
    for r in rows:
        for marked, _, codes in steps_of(r["text"]):
            e = model.emission(marked, codes)
            # ``into`` is absent before the first step: its entry is the role before it.
            into = model.move + e if into is None else (
                into[:, :, None] + model.move[None]).max(axis=1) + e
    return into


def _edges(model: Model):
    """The first and last conversation of a partition, with their matrices."""
    def run(batches):
        pid, kept, conv = TaskContext.get().partitionId(), [], None
        for c, rows in _runs(batches):
            if kept and c == conv:
                # Only the first and the last conversation can cross an edge;
                # a middle one is dropped when the next begins.
                kept[-1][1] = best_scores(model, kept[-1][1], rows)
                if kept[-1][2] is not None:
                    kept[-1][2] = _from_start(model, kept[-1][2], rows)
            else:
                kept = kept[:1] + [[c, best_scores(model, None, rows), _from_start(model, None, rows)]]
                conv = c
        for i, (c, m, s) in enumerate(kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([i], pa.int32()), pa.array([repr(c)]),
                 pa.array([m.ravel()], pa.list_(pa.float64())),
                 pa.array([s], pa.list_(pa.float64()))],
                names=["pid", "i", "conv", "m", "s"])
    return run


def _from_start(model: Model, score: np.ndarray | None, rows: list[dict]) -> np.ndarray:
    """Best scores of each role after these turns of a conversation that begins with them."""
    for r in rows:
        for marked, _, codes in steps_of(r["text"]):
            e = model.emission(marked, codes)
            score = model.start + e if score is None else (score[:, None] + model.move).max(axis=0) + e
    return score


def chain(edges: list, n: int) -> tuple[dict[int, int], dict[int, int]]:
    """Role before a partition's first row, and at its last row, where a conversation crosses.

    ``edges``: rows (pid, i, conv, m, s) of ``_edges``.
    """
    before: dict[int, int] = {}
    at_end: dict[int, int] = {}
    by: dict[int, list] = {}
    for e in sorted(edges, key=lambda e: (e["pid"], e["i"])):
        by.setdefault(e["pid"], []).append(e)
    pids, k = sorted(by), 0
    while k < len(pids):
        # A run: the last conversation of pids[k] and its continuations.
        run, j = [by[pids[k]][-1]], k + 1
        while j < len(pids) and by[pids[j]][0]["conv"] == run[0]["conv"]:
            run.append(by[pids[j]][0])
            j += 1
            if len(by[pids[j - 1]]) > 1:  # the conversation ends inside this partition
                break
        moves = [np.array(e["m"]).reshape(n, n) for e in run]
        scores = [np.array(run[0]["s"])]
        for m in moves[1:]:
            scores.append((scores[-1][:, None] + m).max(axis=0))
        role = int(scores[-1].argmax())
        for i in range(len(run) - 1, 0, -1):
            role = int((scores[i - 1] + moves[i][:, role]).argmax())
            before[run[i]["pid"]] = at_end[run[i - 1]["pid"]] = role
        k = j - 1 if len(run) > 1 and len(by[run[-1]["pid"]]) > 1 else j
    return before, at_end


def _decode(model: Model, before: dict[int, int], at_end: dict[int, int],
            types: tuple[pa.DataType, pa.DataType]):
    def run(batches):
        pid = TaskContext.get().partitionId()
        n = len(model.roles)
        held: list[tuple] = []      # (conv, turn, part, text) of undecided steps
        back: list[np.ndarray] = []  # best role before, for each role at the step
        score, conv, first = None, None, True

        def path(role: int, upto: int) -> list[int]:
            roles = [role]
            for i in range(upto - 1, 0, -1):
                roles.append(int(back[i][roles[-1]]))
            return roles[::-1]

        def emit(roles: list[int]):
            cols = [[] for _ in range(6)]
            for (c, turn, part, text), s in zip(held, roles):
                role = model.roles[s]
                for col, v in zip(cols, (c, turn, part, role, text,
                                         f"<|{role}|>\n{text}\n<|end|>\n")):
                    col.append(v)
            kinds = (*types, pa.int32(), pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["conv_id", "turn", "part", "role", "text", "rendered"])

        def close(role: int | None):
            return emit(path(int(score.argmax()) if role is None else role, len(held)))

        for c, rows in _runs(batches):
            if first or c != conv:
                if held:
                    yield close(None)
                entry = before.get(pid) if first else None
                held, back, conv, score, first = [], [], c, None, False
            for r in rows:
                for part, (marked, text, codes) in enumerate(steps_of(r["text"])):
                    e = model.emission(marked, codes)
                    if score is None:
                        score = (model.start if entry is None else model.move[entry]) + e
                        back.append(np.zeros(n, np.int64))
                    else:
                        through = score[:, None] + model.move
                        back.append(through.argmax(axis=0))
                        score = through.max(axis=0) + e
                    held.append((c, r["turn"], part, text))
            if len(held) > HELD:
                # All survivors share one past from the last step where they meet.
                now, meet = set(range(n)), None
                for i in range(len(held) - 1, 0, -1):
                    now = {int(back[i][s]) for s in now}
                    if len(now) == 1:
                        meet = i
                        break
                if meet:
                    yield emit(path(now.pop(), meet))
                    held, back = held[meet:], back[meet:]
        if held:
            yield close(at_end.get(pid))
    return run


def parse_transcripts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, part, role, text, rendered for every step of every turn."""
    spark = conversations.sparkSession
    prepare(spark)
    checkpoint_dir(spark)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "text", "role"]
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    # Frozen once: a run that crosses partitions needs the same edges in every pass.
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    model = fit(rows)
    edges = rows.mapInArrow(
        _edges(model), "pid int, i int, conv string, m array<double>, s array<double>").collect()
    before, at_end = chain(edges, len(model.roles))
    types = tuple(pa.int64() if rows.schema[c].dataType.simpleString() == "bigint" else
                  pa.int32() if rows.schema[c].dataType.simpleString() == "int" else pa.string()
                  for c in ("conv_id", "turn"))
    out = OUT.format(*(rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")))
    return rows.mapInArrow(_decode(model, before, at_end, types), out)
