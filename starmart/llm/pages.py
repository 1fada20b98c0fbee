"""Main text of pages by structure and a suffix array of each host (operator 3).

A page becomes a stream of words and tags. The streams of a host's pages are
laid end to end and sorted as a suffix array (by doubling, to a depth of
``DEPTH`` tokens): equal prefixes of that depth that start on distinct pages
are repeats, and the union of their places is what the repeats cover.

What is kept of a page:
- never what its markup names as something else: scripts, styles, menus,
  headers, footers, sidebars, forms, adverts, notices, reader comments, hidden
  parts;
- with an article (or a main part): the text inside it, except blocks of a
  classed container that the host repeats: at least ``TEMPLATE`` of that
  container's tokens in articles are covered, on three pages or more;
- without one: the unique runs, that is all blocks but those mostly covered.

Repeats alone cannot decide inside an article: articles quote shared passages,
and a host with a single page repeats nothing. So marks protect plain article
text: it is neither decided by repeats nor evidence against text elsewhere, and stands in
its page's stream as one token, its hash. The repeats decide all other text that marks do
not name.

Html is never shuffled. A task sorts the pages it reads in portions of ``PORTION`` bytes,
a suffix array for the pages of all hosts of the portion (a token of another host is
another token), and sends each distinct run of ``DEPTH`` tokens once: 48 bits of the run's
hash, which holds the host, and where one page alone has it 48 bits of that page's name.
These are dealt by the hash; runs that two pages of one host have, in one portion or in
two, are repeats, whatever the size of the host. Repeats go back, by page name, only to pages that
have text to decide. Template containers are counted over a host by partial sums.

Defined cases: a null or empty html has an empty text; a page without a url
belongs to the host ``""``; pages with equal streams of tokens (copies, with
whatever ids) count as one page, and each row gets its text; unclosed and stray tags are tolerated; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import default_parallelism

from .common import prepare, staged
from .minhash import mix

DEPTH = 8
TEMPLATE, PAGES = 0.8, 3
#: Bytes of html whose streams a task sorts together.
PORTION = 8 << 20

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
                  r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby "
    "rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main nav ol p pre section table ul".split())
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
              "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Elements and names of classes, ids and roles that are not main text.
NOT_TEXT = frozenset(
    "head title script style noscript template nav header footer aside form menu dialog button "
    "select textarea input iframe object svg canvas audio video map datalist".split())
NOT_MAIN = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside complementary "
    "footer foot contentinfo header masthead topbar cookie cookies consent gdpr notice notices "
    "alert newsletter subscribe subscription signup popup modal overlay share sharing social "
    "related recommended comment comments reply replies respond disqus discussion login search "
    "form widget widgets toolbar pagination pager skip hidden".split())


class Block:
    __slots__ = ("text", "main", "dropped", "sign", "first", "size")

    def __init__(self, text, main, dropped, sign, first, size):
        self.text, self.main, self.dropped, self.sign = text, main, dropped, sign
        self.first, self.size = first, size


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "")
            for m in _ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def _names(a: dict[str, str]) -> set[str]:
    joined = " ".join(a.get(k, "") for k in ("class", "id", "role"))
    return set(_PARTS.split(_CAMEL.sub(" ", joined).lower())) - {""}


def parse(page: str | None) -> tuple[list[str], list[Block]]:
    """The token stream of a page and its blocks, each with its place in the stream."""
    page = page or ""
    stream: list[str] = []
    blocks: list[Block] = []
    # Open elements: (tag, drops, is article, is main part, sign of a classed container).
    stack: list[tuple[str, bool, bool, bool, str]] = []
    state = (False, False, False, "")  # dropped, in article, in main part, sign
    parts: list[str] = []

    def text(raw: str) -> None:
        if raw:
            parts.append(entities.unescape(raw) if "&" in raw else raw)

    def close_block() -> None:
        words = "".join(parts).split()
        parts.clear()
        if words:
            dropped, article, main, sign = state
            blocks.append(Block(" ".join(words), 2 if article else int(main), dropped, sign,
                                len(stream), len(words)))
            stream.extend(words)

    def settle() -> None:
        nonlocal state
        sign = next((e[4] for e in reversed(stack) if e[4]), "")
        state = (any(e[1] for e in stack), any(e[2] for e in stack),
                 any(e[3] for e in stack), sign)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            close_block()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag in INLINE and any(e[0] not in INLINE for e in stack[i:]):
                        break  # a stray inline end must not close a container
                    del stack[i:]
                    settle()
                    break
            if tag not in INLINE:
                stream.append("</" + tag + ">")
            continue
        if tag in VOID:
            if tag == "br":
                parts.append(" ")
            continue
        if tag in CLOSES_P or tag in SAME_LEVEL:
            ends = {"p"} if tag in CLOSES_P else SAME_LEVEL[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
        a = _attributes(m[3])
        names = _names(a)
        if tag in ("html", "body"):
            names = set()
        elif tag in ("article", "main") or "main" in names:
            names &= {"comment", "comments"}
        hidden = ("hidden" in a or a.get("aria-hidden", "").lower() == "true"
                  or "display:none" in a.get("style", "").lower().replace(" ", ""))
        drops = tag in NOT_TEXT or hidden or not NOT_MAIN.isdisjoint(names)
        sign = f"{tag}.{a['class']}" if a.get("class") and tag not in INLINE else ""
        if tag not in INLINE:
            stream.append(f"<{tag}.{a.get('class', '')}>")
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            at = max(stop.end(), at)
            continue
        if m[3].endswith("/") and tag in ("svg", "path"):
            continue
        stack.append((tag, drops, tag == "article", tag == "main" or a.get("role") == "main", sign))
        settle()
    close_block()
    return _protected(stream, blocks), blocks


def _protected(stream: list[str], blocks: list[Block]) -> list[str]:
    """The stream with a mark for each block of plain article text; the other blocks move along.

    The mark is the block's hash: pages of different articles stay different pages.
    """
    level, found = _candidates(blocks)
    plain = {id(b) for b in found if level and not b.sign}
    if not plain:
        return stream
    out, at = [], 0
    for b in blocks:
        out += stream[at:b.first]
        at = b.first + b.size
        words, b.first = stream[b.first:at], len(out)
        out += words if id(b) not in plain else [
            "\x01" + hashlib.blake2b(b.text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()]
    return out + stream[at:]


def suffixes(rank: np.ndarray, page: np.ndarray, sizes: np.ndarray):
    """The suffix array of streams laid end to end: places of whole runs, their ranks and pages.

    ``rank``: a number for each token. Sorted by run, then by page.
    """
    last = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(page))  # tokens left on the page
    depth = 1
    while depth < DEPTH:  # suffix ranks by doubling; a suffix ends with its page
        after = np.full(len(rank), -1, np.int64)
        after[:-depth] = rank[depth:]
        after[last <= depth] = -1
        rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1]
        depth *= 2
    whole = np.flatnonzero(last >= DEPTH)
    order = whole[np.lexsort((page[whole], rank[whole]))]
    return order, rank[order], page[order]


def _laid(streams: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens end to end, the page of each, and the pages' sizes."""
    sizes = np.array([len(s) for s in streams], np.int64)
    return (np.array([t for s in streams for t in s], object),
            np.repeat(np.arange(len(streams)), sizes), sizes)


def covered(streams: list[list[str]]) -> list[np.ndarray]:
    """Which tokens of each page stand in a run of ``DEPTH`` that other pages hold too.

    Equal streams are copies of one page and do not make each other repeats.
    """
    distinct = dict.fromkeys(map(tuple, streams))
    if len(distinct) < len(streams):
        found = dict(zip(distinct, covered(list(distinct))))
        return [found[tuple(s)] for s in streams]
    words, page, sizes = _laid(streams)
    if not len(words):
        return [np.zeros(0, bool) for _ in streams]
    order, r, p = suffixes(pd.factorize(words)[0].astype(np.int64), page, sizes)
    if not len(order):
        return [np.zeros(n, bool) for n in sizes]
    first = np.append(True, r[1:] != r[:-1])
    ends = np.append(np.flatnonzero(first)[1:], len(r)) - 1
    shared = np.repeat(p[first] != p[ends], np.diff(np.append(np.flatnonzero(first), len(r))))
    return _spread(order[shared], sizes)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The tokens of each page that stand in one of the runs at ``starts``."""
    edge = np.zeros(sizes.sum() + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + DEPTH, -1)
    return np.split(np.cumsum(edge[:-1]) > 0, np.cumsum(sizes)[:-1])


def token_hashes(host: str, words: np.ndarray) -> np.ndarray:
    """Hashes of tokens; those of another host differ."""
    own = np.frombuffer(hashlib.blake2b(host.encode(), digest_size=8).digest(), np.uint64)[0]
    return mix(pd.util.hash_array(words) ^ own) if len(words) else np.zeros(0, np.uint64)


def name_of(tokens: np.ndarray) -> int:
    """48 bits that name a page by its host and stream."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=6).digest(), "little")


def runs_at(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """48-bit hashes of the runs that start at ``starts``."""
    run = np.zeros(len(starts), np.uint64)
    for i in range(DEPTH):
        run = mix(run * np.uint64(0x9E3779B97F4A7C15) + tokens[starts + i])
    return (run >> np.uint64(16)).astype(np.int64)


def _candidates(blocks: list[Block]) -> tuple[int, list[Block]]:
    """What marks leave of a page: 0 for no article or main part, and the blocks."""
    level = max((b.main for b in blocks if not b.dropped), default=0)
    return level, [b for b in blocks if not b.dropped and b.main >= level]


def _open_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks that repeats decide."""
    level, found = _candidates(blocks)
    return [b for b in found if not level or b.sign]


def _signs(blocks: list[Block], mark: np.ndarray) -> dict[str, list[int]]:
    """Covered tokens and tokens of each classed container in a page's article."""
    seen: dict[str, list[int]] = {}
    level, found = _candidates(blocks)
    for b in found if level else ():
        if b.sign:
            entry = seen.setdefault(b.sign, [0, 0])
            entry[0] += int(mark[b.first:b.first + b.size].sum())
            entry[1] += b.size
    return seen


def _pieces(blocks: list[Block], mark: np.ndarray) -> list[tuple[str, str]]:
    """(text, sign) of what a page keeps unless the host has the sign as template."""
    level, found = _candidates(blocks)
    return [(b.text, b.sign if level else "") for b in found
            if level or mark[b.first:b.first + b.size].sum() <= b.size / 2]


def _distinct(pages: Iterable[str | None]) -> tuple[list, list[int]]:
    """Each distinct page read once, and its place for every page."""
    place: dict[str | None, int] = {}
    copies = [place.setdefault(p, len(place)) for p in pages]
    return [parse(p) for p in place], copies


def extract(pages: list[str | None]) -> list[str]:
    """The main text of each page of one host, its pages side by side."""
    parsed, copies = _distinct(pages)
    marks = covered([s for s, _ in parsed])
    # Classed containers inside articles: covered tokens, tokens, pages.
    seen: dict[str, list] = {}
    counted = set()
    for (stream, blocks), mark in zip(parsed, marks):
        if tuple(stream) in counted:
            continue
        counted.add(tuple(stream))
        for s, (c, n) in _signs(blocks, mark).items():
            entry = seen.setdefault(s, [0, 0, 0])
            seen[s] = [entry[0] + c, entry[1] + n, entry[2] + 1]
    template = {s for s, (c, n, p) in seen.items() if p >= PAGES and c >= TEMPLATE * n}
    out = [" ".join(t for t, s in _pieces(blocks, mark) if s not in template)
           for (_, blocks), mark in zip(parsed, marks)]
    return [out[i] for i in copies]


def _packed(*columns: np.ndarray) -> bytes:
    """Six-byte numbers, byte by byte in planes: the high planes of steps compress away."""
    planes = [np.ascontiguousarray(x.astype("<i8")).view(np.uint8).reshape(len(x), 8).T[:6]
              for x in columns]
    return zstandard.compress(np.concatenate(planes).tobytes() if planes else b"", 3)


def _unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(columns, 6, -1)
    wide = np.zeros((columns, raw.shape[2], 8), np.uint8)
    wide[:, :, :6] = raw.transpose(0, 2, 1)
    return list(wide.reshape(columns, -1).view("<i8"))


def _steps(run: np.ndarray) -> np.ndarray:
    return np.diff(run, prepend=0)


EVIDENCE = "bucket int, shared binary, single binary, asked binary"


def _evidence(buckets: int):
    """Each portion's distinct runs, dealt by their hash.

    ``shared``: runs of two pages or more; ``single``: runs of one page, with its name; ``asked``: runs
    in text that repeats decide, with the name of each page that asks.
    """
    def sent(pages: list[tuple[str, str | None]]):
        streams, opened, hosts = {}, {}, {}
        for host, html in dict.fromkeys(pages):
            stream, blocks = parse(html)
            key = host, *stream
            if key not in streams:
                streams[key] = stream
                hosts.setdefault(host, []).append(key)
                opened[key] = []
            # Copies may differ in what their marks leave open.
            opened[key] += [(b.first, b.size) for b in _open_blocks(blocks)]
        keys = [k for ks in hosts.values() for k in ks]
        words, page, sizes = _laid([streams[k] for k in keys])
        if not len(words):
            return
        at = np.cumsum(sizes) - sizes
        tokens = np.concatenate([token_hashes(h, words[at[i]:at[i] + sum(sizes[i:i + len(ks)])])
                                 for (h, ks), i in zip(hosts.items(), np.cumsum(
                                     [0, *map(len, hosts.values())]).tolist())])
        names = np.array([name_of(t) for t in np.split(tokens, at[1:])], np.int64)
        order, rank, where = suffixes(np.unique(tokens, return_inverse=True)[1], page, sizes)
        if not len(order):
            return
        first = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        last = np.append(first[1:], len(rank)) - 1
        run = runs_at(tokens, order[first])
        both = where[first] != where[last]
        shared = np.sort(run[both])
        single, holder = run[~both], names[where[first][~both]]
        sort = np.argsort(single)
        single, holder = single[sort], holder[sort]
        edge = np.zeros(len(words) + 1, np.int64)
        for i, k in zip(at.tolist(), keys):
            for start, size in opened[k]:
                edge[max(i, i + start - DEPTH + 1)] += 1
                edge[i + start + size] -= 1
        wants = np.cumsum(edge[:-1])[order] > 0
        group = np.cumsum(np.append(True, rank[1:] != rank[:-1])) - 1
        asked, asker = run[group[wants]], names[where[wants]]
        sort = np.argsort(asked)
        asked, asker = asked[sort], asker[sort]
        cuts = (np.arange(buckets + 1, dtype=object) * (1 << 48) // buckets).astype(np.int64)
        parts = [np.searchsorted(x, cuts) for x in (shared, single, asked)]
        rows = []
        for k in range(buckets):
            (a, b), (c, d), (e, f) = ((p[k], p[k + 1]) for p in parts)
            if b > a or d > c or f > e:
                rows.append((k, _packed(_steps(shared[a:b])), _packed(_steps(single[c:d]), holder[c:d]),
                             _packed(_steps(asked[e:f]), asker[e:f])))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))],
                names=["bucket", "shared", "single", "asked"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                held.append((host, html))
                size += len(html or "")
                if size >= PORTION:
                    yield from sent(held)
                    held, size = [], 0
        yield from sent(held)
    return run


def _repeats(group: pa.Table) -> pa.Table:
    """The runs of a bucket that distinct pages hold, to each page that asks for them."""
    shared = [np.cumsum(_unpacked(x, 1)[0]) for x in group.column("shared").to_pylist()]
    single = [_unpacked(x, 2) for x in group.column("single").to_pylist()]
    asked = [_unpacked(x, 2) for x in group.column("asked").to_pylist()]
    wanted = np.concatenate([np.cumsum(r) for r, _ in asked])
    asker = np.concatenate([n for _, n in asked])
    run = np.concatenate([np.cumsum(r) for r, _ in single])
    name = np.concatenate([n for _, n in single])
    keep = np.isin(run, wanted)
    run, name = run[keep], name[keep]
    order = np.lexsort((name, run))
    run, name = run[order], name[order]
    known = np.unique(np.concatenate([*shared, run]))
    several = run[:-1][(run[1:] == run[:-1]) & (name[1:] != name[:-1])]
    once = np.setdiff1d(run, np.concatenate([several, *shared]))
    repeated = np.setdiff1d(known, once)
    hit = np.isin(wanted, repeated)
    wanted, asker = wanted[hit], asker[hit]
    order = np.lexsort((wanted, asker))
    names, at = np.unique(asker[order], return_index=True)
    return pa.table({"name": pa.array(names, pa.int64()), "runs": pa.ListArray.from_arrays(
        pa.array(np.append(at, len(wanted)), pa.int32()), pa.array(wanted[order], pa.int64()))})


def _texts(batches):
    """Pages of a table without repeats in open text: what the marks leave."""
    for b in batches:
        texts = [" ".join(x.text for x in _candidates(parse(h)[1])[1])
                 for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"])


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("sign", pa.string()), ("level", pa.int32()),
                              ("first", pa.int64()), ("size", pa.int64())]))
OPEN = ("name long, text string, starts array<long>, runs array<long>, blocks array<struct<text string, "
        "sign string, level int, first long, size long>>")


def _opened(batches):
    """Each page's text where marks decide all of it, else its blocks and the runs in open ones."""
    for b in batches:
        rows = []
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            stream, blocks = parse(html)
            level, found = _candidates(blocks)
            ask = [x for x in found if not level or x.sign]
            if not ask:
                rows.append((None, " ".join(x.text for x in found), None, None, None))
                continue
            tokens = token_hashes(host, np.array(stream, object))
            starts = [np.arange(max(0, x.first - DEPTH + 1), min(x.first + x.size, len(stream) - DEPTH + 1))
                      for x in ask]
            starts = np.unique(np.concatenate(starts)).astype(np.int64)
            rows.append((name_of(tokens), None, starts, runs_at(tokens, starts),
                         [{"text": x.text, "sign": x.sign if level else "", "level": level,
                           "first": x.first, "size": x.size} for x in found]))
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), _BLOCKS)
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), b.column("host"),
             *(pa.array(c, k) for c, k in zip(cols, kinds))],
            names=["page_id", "url", "host", "name", "text", "starts", "runs", "blocks"])


JUDGED = "kept array<struct<text string, sign string>>, signs array<struct<sign string, covered long, size long>>"


def _judge(batches):
    """What the repeats leave of open pages, and their containers' coverage."""
    for b in batches:
        kept, signs = [], []
        for starts, runs, repeats, blocks in zip(*(b.column(c).to_pylist() for c in (
                "starts", "runs", "repeats", "blocks"))):
            hit = np.isin(np.array(runs, np.int64), np.array(repeats or [], np.int64))
            size = max(x["first"] + x["size"] for x in blocks) + DEPTH
            mark = _spread(np.array(starts, np.int64)[hit], np.array([size]))[0]
            found = [Block(x["text"], x["level"], False, x["sign"], x["first"], x["size"]) for x in blocks]
            kept.append([{"text": t, "sign": s} for t, s in _pieces(found, mark)])
            signs.append([{"sign": s, "covered": c, "size": n} for s, (c, n) in _signs(found, mark).items()])
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("page_id", "url", "host", "name")),
             pa.array(kept, pa.list_(pa.struct([("text", pa.string()), ("sign", pa.string())]))),
             pa.array(signs, pa.list_(pa.struct([
                 ("sign", pa.string()), ("covered", pa.int64()), ("size", pa.int64())])))],
            names=["page_id", "url", "host", "name", "kept", "signs"])


def _decided(rows: DataFrame, repeats: DataFrame, page_type: str) -> DataFrame:
    """Texts where repeats meet open text. Only pages with such text are shuffled, by name."""
    head = f"page_id {page_type}, url string, host string, "
    opened = staged(rows.mapInArrow(_opened, head + OPEN), "pages")
    of_page = repeats.groupBy("name").agg(F.flatten(F.collect_list("runs")).alias("repeats"))
    judged = staged(opened.where("name is not null").join(of_page, "name", "left").select(
        "page_id", "url", "host", "name", "starts", "runs", "repeats", "blocks").mapInArrow(
        _judge, head + "name long, " + JUDGED), "judged")
    # A stream counts once, whatever its copies.
    template = (judged.select("host", "name", F.explode("signs").alias("s"))
                .groupBy("host", "name", F.col("s.sign").alias("sign"))
                .agg(F.max("s.covered").alias("covered"), F.max("s.size").alias("size"))
                .groupBy("host", "sign")
                .agg(F.sum("covered").alias("c"), F.sum("size").alias("n"), F.count("*").alias("p"))
                .where((F.col("p") >= PAGES) & (F.col("c") >= F.lit(TEMPLATE) * F.col("n")))
                .groupBy("host").agg(F.collect_set("sign").alias("template")))
    none = F.array().cast("array<string>")
    text = F.array_join(F.transform(F.filter("kept", lambda b: ~F.array_contains(
        F.coalesce("template", none), b["sign"])), lambda b: b["text"]), " ")
    return judged.join(staged(template, "templates"), "host", "left").select(
        "page_id", "url", text.alias("text")).union(
        opened.where("name is null").select("page_id", "url", "text"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    spark = pages.sparkSession
    prepare(spark)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    page_type = pages.schema["page_id"].dataType.simpleString()
    buckets = default_parallelism(spark)
    repeats = staged(rows.select("host", "html").mapInArrow(_evidence(buckets), EVIDENCE)
                     .groupBy("bucket").applyInArrow(_repeats, "name long, runs array<long>"), "repeats")
    if repeats.isEmpty():
        out = rows.mapInArrow(_texts, f"page_id {page_type}, url string, text string")
    else:
        out = _decided(rows, repeats, page_type)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
