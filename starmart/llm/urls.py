"""URL filters by a bit-parallel wildcard automaton (operator 13).

A canonical URL is ``.`` + host + path: the host after the first ``://`` up to
``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path from there up to ``?``,
``#`` or the end; bytes outside ASCII as ``%XX``. The leading dot lets one pattern
``*.example.org/...`` fit a host and its subdomains.

Globs: ``*`` is any run without ``/``, ``**`` any run, ``?`` one character but ``/``,
``[...]`` one of a set (``[^...]``: none of it), a backslash makes the next character
plain; a glob describes the whole canonical URL. All globs are packed side by side into words
of 64 bits, a bit for each place between symbols. One step of Shift-And reads a
byte for all globs and all URLs of a block at once:

    places = (places << 1) & accepts[byte] | places & loops[byte]

where ``accepts`` has the places that a symbol's byte leads to and ``loops`` those
where a wildcard stays. The shift carries over words, so a glob may be of any length.
Work grows with the URLs' bytes times the words; nothing is shuffled.

A rule (action, host, path) fits its host and all subdomains if the path starts with
the rule's. Of the rules that fit, the longest (host and path) decides, then the
longer host, then block before allow. Without one the method's globs decide: block
before allow, then the one with most plain characters, then the text's order;
without any ``default``.

Defined cases: a null URL, and one without ``://``, has an empty host and path and
gets ``default``; an empty host or path is judged like any other; URLs of any length
are read whole; repeated rows are judged alike; an empty table gives no rows; other
columns are kept by ``allowed`` and ignored by ``filter_urls``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import prepare

# The rules (action, host, path) and, for all other URLs, words that a part of a
# host's name (between dots and hyphens) may not be, and globs.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
WORDS = ["ads", "adserver", "adult", "bets", "betting", "casino", "casinos", "malware", "phishing",
         "pills", "poker", "porn", "spam", "tracker", "viagra", "warez", "xxx"]
GLOBS = [("block", "**/cgi-bin/**"), ("block", "**/wp-admin/**"), ("block", "**/wp-login.php"),
         ("block", "**.exe"), ("block", "**.zip")]

DEFAULT_GLOBS = [("block", f"*[.-]{w}[.-]**") for w in WORDS] + GLOBS
_SLASH, _BYTES = ord("/"), 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of state that a block of URLs holds.
BLOCK_WORDS = 1 << 18


def encoded(text: str) -> bytes:
    """UTF-8 with bytes outside ASCII as ``%XX``."""
    if text.isascii():
        return text.encode()
    return b"".join(bytes([b]) if b < 128 else b"%%%02X" % b for b in text.encode())


@dataclass
class Symbols:
    """A glob as sets of bytes, and after each place (0: before the first) a wildcard or none."""
    sets: list[np.ndarray] = field(default_factory=list)
    loops: dict[int, np.ndarray] = field(default_factory=dict)
    plain: int = 0

    def literal(self, text: str) -> Symbols:
        for b in encoded(text):
            self.sets.append(np.arange(_BYTES) == b)
            self.plain += 1
        return self

    def wild(self, any_byte: bool) -> Symbols:
        at = len(self.sets)
        run = np.full(_BYTES, True) if any_byte else np.arange(_BYTES) != _SLASH
        self.loops[at] = self.loops.get(at, False) | run
        return self


def parse_glob(glob: str) -> Symbols:
    out, i = Symbols(), 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            both = glob[i:i + 2] == "**"
            out.wild(both)
            i += 1 + both
            continue
        if c == "?":
            out.sets.append(np.arange(_BYTES) != _SLASH)
        elif c == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            inside = glob[i + 1:end]
            some = inside.lstrip("^") if inside.startswith("^") else inside
            member = np.isin(np.arange(_BYTES), list(some.encode("ascii")))
            out.sets.append(member if some == inside else ~member)
            i = end
        elif c == "\\" and i + 1 < len(glob):
            i += 1
            out.literal(glob[i])
        else:
            out.literal(c)
        i += 1
    return out


def rule_symbols(host: str, path: str) -> Symbols:
    lower = host.translate(str.maketrans(_UPPER, _LOWER))
    return Symbols().wild(False).literal("." + lower).literal(path).wild(True)


class Automaton:
    """All globs in one state of ``width`` words."""

    def __init__(self, globs: Sequence[Symbols]):
        self.size = len(globs)
        starts = np.cumsum([0] + [len(g.sets) + 1 for g in globs])
        self.width = max(1, -(-int(starts[-1]) // 64))
        bits = np.zeros((2, _BYTES, self.width * 64), bool)
        for at, g in zip(starts.tolist(), globs):
            for k, accepted in enumerate(g.sets):
                bits[0, :, at + k + 1] = accepted
            for k, run in g.loops.items():
                bits[1, :, at + k] = run
        self.accepts, self.loops = np.packbits(bits, axis=2, bitorder="little").view("<u8")
        first = np.zeros(self.width * 64, bool)
        first[starts[:-1]] = True
        self.first = np.packbits(first, bitorder="little").view("<u8")
        self.last = (starts[1:] - 1).tolist()

    def places(self, urls: list[bytes]) -> np.ndarray:
        """The state after each URL: one row of words for each."""
        size = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-size, kind="stable")
        size = size[order]
        flat = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
        start = np.cumsum(size) - size
        state = np.repeat(self.first[None], len(urls), axis=0)
        # URLs that have ended stand last and keep their state.
        for j in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -j))
            byte, now = flat[start[:n] + j], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = moved & self.accepts[byte] | now & self.loops[byte]
        out = np.empty_like(state)
        out[order] = state
        return out

    def first_match(self, urls: list[bytes]) -> np.ndarray:
        """The least number of a glob that fits each URL, ``size`` where none does."""
        best = np.full(len(urls), self.size)
        block = max(1, BLOCK_WORDS // self.width)
        for i in range(0, len(urls), block):
            state = self.places(urls[i:i + block])
            found = best[i:i + block]
            for k in range(self.size - 1, -1, -1):
                word, bit = divmod(self.last[k], 64)
                found[(state[:, word] >> np.uint64(bit) & np.uint64(1)).astype(bool)] = k
        return best


@dataclass
class Filter:
    """Rules and globs in the order in which they decide."""
    automaton: Automaton
    rules: list[str | None]
    globs: list[str | None]
    verdicts: list[str]


def compile_filter(rules=RULES, globs=DEFAULT_GLOBS, default: str = "allow") -> Filter:
    for action in [r[0] for r in rules] + [g[0] for g in globs] + [default]:
        if action not in ("allow", "block"):
            raise ValueError(f"neither allow nor block: {action}")
    ranked = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1]), r[0] != "block", r))
    parsed = sorted(((parse_glob(g), a, g) for a, g in globs),
                    key=lambda x: (x[1] != "block", -x[0].plain, x[2]))
    return Filter(
        Automaton([rule_symbols(h, p) for _, h, p in ranked] + [s for s, _, _ in parsed]),
        [h + p for _, h, p in ranked] + [None] * (len(parsed) + 1),
        [None] * len(ranked) + [g for _, _, g in parsed] + [None],
        [a for a, _, _ in ranked] + [a for _, a, _ in parsed] + [default])


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, _UPPER, _LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    return F.when(F.instr(url, "://") > 0,
                  F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def verdict_of(host: Column, path: Column, compiled: Filter) -> Column:
    """Struct of rule, glob and verdict."""
    fields = [pa.field(n, pa.string()) for n in ("rule", "glob", "verdict")]

    @arrow_udf("rule string, glob string, verdict string")
    def judge(host: pa.Array, path: pa.Array) -> pa.Array:
        urls = [encoded("." + h + p) for h, p in zip(host.to_pylist(), path.to_pylist())]
        found = pa.array(compiled.automaton.first_match(urls))
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.string()).take(found) for x in (
                compiled.rules, compiled.globs, compiled.verdicts)], fields=fields)

    return judge(host, path)


def filter_urls(pages: DataFrame, rules=RULES, globs=DEFAULT_GLOBS, default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (null without one), glob (null under a rule), verdict of each row."""
    prepare(pages.sparkSession, batch_rows=4096)
    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                         path_of(url).alias("path"))
    compiled = compile_filter(rules, globs, default)
    return parts.select("*", verdict_of(F.col("host"), F.col("path"), compiled).alias("v")).select(
        "page_id", "host", "path", "v.rule", "v.glob", "v.verdict")


def allowed(pages: DataFrame, rules=RULES, globs=DEFAULT_GLOBS, default: str = "allow",
            url_col: str = "url") -> DataFrame:
    """The rows whose URL is allowed, with all their columns."""
    prepare(pages.sparkSession, batch_rows=4096)
    url = F.col(url_col).cast("string")
    v = verdict_of(host_of(url), path_of(url), compile_filter(rules, globs, default))
    return pages.where(v["verdict"] == "allow")
