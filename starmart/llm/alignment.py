"""Cross-tokenizer alignment by external spill counting (operator 12).

A text is encoded by a byte-level vocabulary (A, of a space and the text) and by
a piece vocabulary (B, of the text, to which it adds that space itself). Byte
offsets where tokens of both end cut the text into groups; two tokens are linked
where their byte ranges overlap, which is once for each stretch between
neighbouring ends of either side. The corpus counts how many links hold a pair
of ids, and each document gets the counts of its own links back.

1. Spill. A task encodes documents and gathers (pair, document, times) records.
   A few million of them form a chunk: sorted side-major (B id, A id, document),
   dealt over ``RADIX`` parts by the B id and written as one zstd run for each
   part, a directory of the run's pairs beside their documents.
2. Count. A k-way heap merge of the directories in a scan task gives each pair
   once; partial sums by pair add up over tasks. Only directories are read.
3. Contribute. The pairs of a part lie side-major, so one pass gives the highest
   count of each B id; every run of the part then adds count and best flag to its
   documents. A part with many bytes (a B id in a third of all links) is split
   by chunks over as many tasks as its measured size asks for; its pairs, which the
   vocabularies bound, go to each of them. A run sends back one small block for
   its chunk, and a chunk's blocks are added to its documents.

Nothing is broadcast; the driver sees two numbers for each of the ``RADIX`` parts.
Texts are cut before single spaces, where both vocabularies always end a token
(checked when the vocabularies are read), so a word's alignment is kept in a bounded
store and reused.

Defined cases: a null or empty text, and one whose tokens of either side do not
spell a space and the text (B reads U+2581 as a space), has no tokens: zeros and an
empty hash. Repeated rows and null ids are documents of their own. The strings of
special tokens are plain text. A very long text is encoded whole; its records may
fill a chunk alone. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged
from .tokens import _RUN, byte_alphabet, default_tokenizer, encoder

#: Parts that the pairs are dealt over by their B id.
RADIX = 32
#: Records of a chunk.
CHUNK_RECORDS = 4_000_000
#: A record's bits, from the highest: B id, A id, document of the chunk, times.
ID_BITS, DOC_BITS, TIMES_BITS = 20, 14, 9
#: Compressed bytes and runs of a part that one task takes.
PART_BYTES, PART_RUNS = 24 << 20, 512
#: Directories that one merge opens, and their compressed bytes.
FAN_IN, FAN_BYTES = 64, 2 << 20
#: Words that a worker keeps in each of two generations; longer words are not kept.
STORE, KEPT_LENGTH = 150_000, 120
#: Stretches that begin a word and are encoded as one text; bytes whose ends are compared at once.
SIDE, AT_ONCE = 100, 1 << 20

SPILL = ("chunk long, radix int, pairs binary, docs binary, doc_id array<long>, n_a array<long>, "
         "n_b array<long>, n_groups array<long>, n_links array<long>, digest array<string>, "
         "groups array<string>")
_SPILL = pa.schema([
    ("chunk", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("docs", pa.binary()),
    *((c, pa.list_(pa.int64())) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
    ("digest", pa.list_(pa.string())), ("groups", pa.list_(pa.string()))])


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame; each is stored in the least width that holds it."""
    head, body = [len(arrays)], []
    for x in arrays:
        width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
        body.append(x.astype(f"<u{width}").tobytes())
        head += [width, len(x)]
    return zstandard.compress(np.array(head, "<i8").tobytes() + b"".join(body), 3)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, out, at = np.frombuffer(raw, "<i8", 2 * n, 8), [], 8 + 16 * n
    for width, size in head.reshape(-1, 2).tolist():
        out.append(np.frombuffer(raw, f"<u{width}", size, at).astype(np.int64))
        at += width * size
    return out


#: A stretch of text: tokens of A and of B, groups, links (pairs as 64-bit numbers, B first),
#: groups as text.
Entry = tuple[int, int, int, bytes, str]
#: Marks that no letter shares a piece with in common vocabularies (checked when B is read); an
#: apostrophe is not among them, as it may open a contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def joined(entries: list[Entry]) -> Entry:
    """The entry of stretches side by side."""
    if len(entries) == 2:
        (a, b, g, links, groups), (a2, b2, g2, links2, groups2) = entries
        return a + a2, b + b2, g + g2, links + links2, f"{groups};{groups2}"
    n_a, n_b, n_groups, links, groups = zip(*entries)
    return sum(n_a), sum(n_b), sum(n_groups), b"".join(links), ";".join(groups)


class Aligner:
    """Entries of words and of the stretches that words fall into.

    A word follows a space. It is cut at a lone line end (which is a token of both sides)
    and between its letters and the marks behind them, where neither vocabulary goes on; a
    stretch that begins a word keeps its space. None stands for a stretch whose tokens do not
    spell it. Stretches that the store lacks are encoded together.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = encoder(path_a).tok
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n_a, n_b = self.a.get_vocab_size(with_added_tokens=True), len(self.b)
        if max(n_a, n_b) > 1 << ID_BITS:
            raise ValueError(f"a vocabulary has more than {1 << ID_BITS} ids")
        back = {c: b for b, c in byte_alphabet().items()}
        self.bytes_a = [bytes(back[c] for c in t) if t and all(c in back for c in t) else
                        (t or "").encode() for t in map(self.a.id_to_token, range(n_a))]
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else
                        p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        # An id's digits with each of the marks that may follow it, one below the other.
        names = np.array([f"{i}{m}".encode() for i in range(max(n_a, n_b)) for m in ",|;"])
        self.names = names.view(np.uint8).reshape(len(names), -1)
        self.name_size = (self.names != 0).sum(1)
        # Where a piece goes on over a space, a line end or from a letter to a mark, nothing is cut.
        self.spaced = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lined = not any("\n" in p for p in pieces)
        spanned = {y for p in pieces for x, y in zip(p, p[1:]) if x.isalpha()}
        self.marks = "".join(m for m in MARKS if m not in spanned)
        self.line = len(self.b.encode("\n")) - 1
        self.words: dict[str, Entry | None] = {}
        self.old: dict[str, Entry | None] = {}
        self.parts: dict[str, Entry | None] = {}

    def entries(self, ids_a: np.ndarray, ids_b: np.ndarray, stop: np.ndarray) -> list[Entry] | None:
        """Entries of stretches that end at the bytes ``stop`` of what both sides' ids spell.

        None where a token goes on over the end of a stretch.
        """
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        ends_a, ends_b = np.zeros((2, int(stop[-1]) + 1), bool)
        ends_a[end_a] = ends_b[end_b] = True
        shared = ends_a & ends_b
        if not shared[stop].all():
            return None
        # Tokens and groups that end up to each byte.
        upto_a, upto_b, upto = (np.cumsum(x, dtype=np.int32) for x in (ends_a, ends_b, shared))
        at = np.flatnonzero(ends_a | ends_b)
        links = (ids_b[upto_b[at] - ends_b[at]] << ID_BITS | ids_a[upto_a[at] - ends_a[at]]).tobytes()
        # A group's tokens of A, then those of B, each with the mark behind it.
        shut_a, shut_b = ends_b[end_a], ends_a[end_b]
        bounds = np.append(0, np.flatnonzero(shared))
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        code[np.arange(len(ids_a)) + upto_b[bounds[upto[end_a] - shut_a]]] = 3 * ids_a + shut_a
        code[np.arange(len(ids_b)) + upto_a[bounds[upto[end_b] - shut_b + 1]]] = 3 * ids_b + 2 * shut_b
        names = self.names[code].ravel()
        groups = names[names != 0].tobytes().decode()
        n_a, n_b, n_groups = upto_a[stop], upto_b[stop], upto[stop]
        link = (8 * (n_a + n_b - n_groups).astype(np.int64)).tolist()
        mark = np.cumsum(self.name_size[code])[n_a + n_b - 1].tolist()
        return list(zip(*(np.diff(x, prepend=0).tolist() for x in (n_a, n_b, n_groups)),
                        [links[i:j] for i, j in zip([0, *link], link)],
                        [groups[i:j - 1] for i, j in zip([0, *mark], mark)]))

    def encoded(self, stretches: list[str], side: int = SIDE) -> list[Entry | None]:
        """Entries of stretches; those of a word's beginning start with its space.

        As both sides end a token before it, ``side`` of these are encoded as one text.
        """
        blocks, alone = [[]], []
        for i, t in enumerate(stretches):
            if side == 1 or t[0] != " " or "▁" in t:
                alone.append([i])
            else:
                if len(blocks[-1]) == side:
                    blocks.append([])
                blocks[-1].append(i)
        blocks = [b for b in blocks if b] + alone
        texts = ["".join([stretches[i] for i in b]) for b in blocks]
        ids_a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B adds a space itself; behind a line end it adds none.
        ids_b = self.b.encode([t[1:] if t[0] == " " else t if t == "\n" else "\n" + t
                               for t in texts], num_threads=1)
        ids_b = [b if t[0] == " " else b[self.line:] if t == "\n" else b[self.line + 1:]
                 for t, b in zip(texts, ids_b)]
        out: list[Entry | None] = [None] * len(stretches)
        again, held, size = [], [], 0
        for k, (block, text) in enumerate(zip(blocks, texts)):
            raw = text.encode()
            if (b"".join(map(self.bytes_a.__getitem__, ids_a[k])) == raw
                    and b"".join(map(self.bytes_b.__getitem__, ids_b[k])) == raw):
                held.append(k)
                size += len(raw)
            elif len(block) > 1:
                again += block
            if held and (size > AT_ONCE or k == len(blocks) - 1):
                a, b = (np.fromiter(chain.from_iterable([x[h] for h in held]), np.int64)
                        for x in (ids_a, ids_b))
                places = [i for h in held for i in blocks[h]]
                stop = np.cumsum([len(stretches[i].encode()) for i in places])
                entries = self.entries(a, b, stop)
                if entries is None:
                    again += places
                else:
                    for i, e in zip(places, entries):
                        out[i] = e
                held, size = [], 0
        if again and side > 1:
            for i, e in zip(again, self.encoded([stretches[i] for i in again], 1)):
                out[i] = e
        return out

    def cut(self, word: str) -> list[str]:
        """The stretches of ``word``, which holds no space; the first is thought behind one."""
        lines = word.split("\n") if self.lined and "\n" in word else [word]
        if len(lines) > 1 and any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            lines = [word]
        out = []
        for k, line in enumerate(lines):
            if k:
                out.append("\n")
            core = line.rstrip(self.marks)
            if core.isalpha() and len(core) < len(line):
                out += [core, line[len(core):]]
            else:
                out.append(line)
        return out

    def lookup(self, words: list[str]) -> list[Entry | None]:
        """The entries of words, each behind a space."""
        kept, old, parts = self.words, self.old, self.parts
        # False stands for a word that the store lacks.
        out = [kept.get(w, False) for w in words]
        uncut, cuts, begins, others = [], [], {}, {}
        for i in [i for i, e in enumerate(out) if e is False]:
            w = words[i]
            if w in old:
                out[i] = kept[w] = old[w]
                continue
            if w.isalpha():
                uncut.append(i)
                begins[w] = None
                continue
            stretches = self.cut(w)
            cuts.append((i, stretches))
            begin = stretches[0]  # a word, too
            if begin not in kept:
                if begin in old:
                    kept[begin] = old[begin]
                else:
                    begins[begin] = None
            for x in stretches[1:]:
                if x not in parts:
                    others[x] = None
        found = iter(self.encoded([" " + x for x in begins] + list(others)))
        for new, store in ((begins, kept), (others, parts)):
            new.update(zip(list(new), found))
            if max(map(len, new), default=0) <= KEPT_LENGTH:
                store.update(new)
            else:
                store.update((x, e) for x, e in new.items() if len(x) <= KEPT_LENGTH)
        for i in uncut:
            out[i] = begins[words[i]]
        for i, stretches in cuts:
            w, begin = words[i], stretches[0]
            e = begins[begin] if begin in begins else kept[begin]
            if len(stretches) > 1:
                entries = [e, *(others[x] if x in others else parts[x] for x in stretches[1:])]
                e = None if None in entries else joined(entries)
                if len(w) <= KEPT_LENGTH:
                    kept[w] = e
            out[i] = e
        if len(kept) > STORE:
            self.words, self.old = {}, kept
        if len(parts) > STORE:
            self.parts = {}
        return out

    def whole(self, texts: list[str]) -> list[Entry | None]:
        """The entries of a space and each text, asked of both libraries at once."""
        return self.encoded([" " + t for t in texts], 1) if texts else []


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _expand(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places ``starts[i] ... starts[i] + sizes[i]`` one after another."""
    stop = np.cumsum(sizes)
    return np.repeat(starts - (stop - sizes), sizes) + np.arange(int(stop[-1]) if len(stop) else 0)


class Chunk:
    """Documents and records that a task holds until they are spilled."""

    def __init__(self, number: int):
        self.number = number
        self.docs: list[tuple] = []
        self.records: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        most = (1 << TIMES_BITS) - 1
        while len(pair):
            now = np.minimum(times, most)
            self.records.append((pair << DOC_BITS | doc) << TIMES_BITS | now)
            self.size += len(pair)
            left = times > most  # a very long text: the rest is a record of its own
            doc, pair, times = doc[left], pair[left], times[left] - most

    def spill(self):
        """Batches of the chunk's runs and of its documents."""
        rows = []
        if self.records:
            record = np.sort(np.concatenate(self.records))
            self.records = []
            named = record >> TIMES_BITS
            first = np.flatnonzero(np.append(True, named[1:] != named[:-1]))
            times = np.add.reduceat(record & ((1 << TIMES_BITS) - 1), first)
            named = named[first]
            pair, doc = named >> DOC_BITS, named & ((1 << DOC_BITS) - 1)
            part = radix_of(pair >> ID_BITS).astype(np.uint8)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(RADIX + 1))
            for r in range(RADIX):
                at = order[bounds[r]:bounds[r + 1]]
                if len(at):
                    rows.append((r, *run_of(pair[at], doc[at], times[at])))
        for r, pairs, docs in rows:
            yield _row(chunk=self.number, radix=r, pairs=pairs, docs=docs)
        cols = list(zip(*self.docs)) or [()] * 7
        yield _row(chunk=self.number, radix=-1, **{
            n: list(c) for n, c in zip(_SPILL.names[4:], cols)})


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([values.get(f.name)], f.type) for f in _SPILL], schema=_SPILL)


def radix_of(b: np.ndarray) -> np.ndarray:
    return (b * 0x9E3779B1 >> 12) % RADIX


def run_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """A run: its directory (pairs, links, documents of each), and documents with times."""
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    step = np.diff(doc, prepend=0)
    step[first] = doc[first]
    key = pair[first]
    return (packed(np.diff(key, prepend=0), np.add.reduceat(times, first),
                   np.diff(np.append(first, len(pair)))), packed(step, times))


def _spill(path_a: str, path_b: str, keep_groups: bool):
    def run(batches):
        al, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        chunk = Chunk(number)
        for ids, texts in _portions(batches):
            if len(chunk.docs) + len(texts) > 1 << DOC_BITS:
                yield from chunk.spill()
                chunk = Chunk(chunk.number + 1)
            _gather(al, chunk, ids, texts, keep_groups)
            if chunk.size >= CHUNK_RECORDS:
                yield from chunk.spill()
                chunk = Chunk(chunk.number + 1)
        if chunk.docs:
            yield from chunk.spill()
    return run


def _portions(batches, at_once: int = 2_000_000, most_rows: int = 2_048):
    """Ids and texts of a bounded number of rows and characters, or of one text, over batches.

    The more there are, the fewer of their distinct words come again in the next portion.
    """
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            n = len(t or "")
            if texts and (size + n > at_once or len(texts) == most_rows):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += n
    if texts:
        yield ids, texts


def _gather(al: Aligner, chunk: Chunk, ids: list, texts: list, keep_groups: bool) -> None:
    n = len(texts)
    whole = [bool(t) and (not al.spaced or _RUN.search(" " + t) is not None) for t in texts]
    cut = pc.split_pattern(pa.array(["" if w else t or "" for t, w in zip(texts, whole)],
                                    pa.large_string()), " ")
    coded = cut.flatten().dictionary_encode()
    at = coded.indices.to_numpy()
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    found = iter(al.lookup([w for w in words if w]))
    entries = [next(found) if w else None for w in words]
    doc_of = np.repeat(np.arange(n), np.diff(cut.offsets.to_numpy()))
    base = len(entries)
    alone = [i for i in range(n) if whole[i]]
    entries += al.whole([texts[i] for i in alone])
    lost = np.array([e is None for e in entries], bool)
    entries = [e or (0, 0, 0, b"", "") for e in entries]
    # Texts cut into words (in their order), then whole ones; a text with a lost stretch has none.
    keep = ~np.array(whole, bool)[doc_of]
    doc = np.append(doc_of[keep], alone).astype(np.int64)
    at = np.append(at[keep], base + np.arange(len(alone))).astype(np.int64)
    bad = np.zeros(n, bool)
    bad[doc[lost[at]]] = True
    use = ~bad[doc]
    doc, at = doc[use], at[use]
    n_a, n_b, n_groups, links, texts_of = zip(*entries)
    sums = np.zeros((n, 3), np.int64)
    np.add.at(sums, doc, np.array([n_a, n_b, n_groups], np.int64).T[at])
    order = np.argsort(doc, kind="stable")
    place = at[order].tolist()
    bounds = np.searchsorted(doc[order], np.arange(n + 1)).tolist()
    start = len(chunk.docs)
    for i, (a, b, g) in enumerate(sums.tolist()):
        groups = ";".join([texts_of[k] for k in place[bounds[i]:bounds[i + 1]]])
        # Each stretch between neighbouring ends of either side is a link.
        chunk.docs.append((ids[i], a, b, g, a + b - g,
                           hashlib.sha256(groups.encode()).hexdigest() if groups else "",
                           groups if keep_groups else None))
    # Distinct (document, stretch) first, then their links.
    both, often = np.unique(doc * len(entries) + at, return_counts=True)
    doc, at = both // len(entries), both % len(entries)
    sizes = np.fromiter(map(len, links), np.int64, len(links)) // 8
    starts = np.cumsum(sizes) - sizes
    pairs = np.frombuffer(b"".join(links), np.int64)
    chunk.add(start + np.repeat(doc, sizes[at]), pairs[_expand(sizes[at], starts[at])],
              np.repeat(often, sizes[at]))


def _directory(data: bytes):
    """(pair, links) of a run in ascending order, decoded when the merge first asks."""
    step, links, _ = unpacked(data)
    yield from zip(np.cumsum(step).tolist(), links.tolist())


def merge_directories(directories: list[bytes]):
    """(pair, links) of each pair once: a k-way heap merge of sorted runs."""
    merged = heapq.merge(*map(_directory, directories), key=itemgetter(0))
    for pair, same in groupby(merged, key=itemgetter(0)):
        yield pair, sum(n for _, n in same)


def _count(batches):
    """Partial counts of each pair, from merges of a bounded number of directories."""
    def counted(directories):
        merged = merge_directories(directories)
        while found := list(islice(merged, 65_536)):
            pair, n = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())],
                                             names=["pair", "n"])

    held: list[bytes] = []
    for b in batches:
        for data in b.column("pairs").to_pylist():
            held.append(data)
            if len(held) == FAN_IN or sum(map(len, held)) > FAN_BYTES:
                yield from counted(held)
                held = []
    yield from counted(held)


def _contribute(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """What each run's pairs give to the documents of its chunk: counts, and links of best pairs."""
    pair, n = (totals.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)  # side-major: all pairs of a B id side by side
    pair, n = pair[order], n[order]
    side = pair >> ID_BITS
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))[:len(pair)]
    best = np.zeros(0, bool)
    if len(pair):
        best = n == np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(pair))))
    blocks = []
    for keys, docs in zip(runs.column("pairs"), runs.column("docs")):
        step, _, many = unpacked(keys.as_py())
        at = np.repeat(np.searchsorted(pair, np.cumsum(step)), many)
        step, times = unpacked(docs.as_py())
        # A pair's documents ascend by steps; its first step is the document itself.
        first, ran = np.cumsum(many) - many, np.cumsum(step)
        doc = ran - np.repeat(ran[first] - step[first], many)
        total, top = np.zeros((2, int(doc.max()) + 1), np.int64)
        np.add.at(total, doc, n[at] * times)
        np.add.at(top, doc, best[at] * times)
        seen = np.flatnonzero(total)
        blocks.append(packed(np.diff(seen, prepend=0), total[seen], top[seen]))
    return pa.table({"chunk": runs.column("chunk"), "block": pa.array(blocks, pa.binary())})


def _finish(docs: pa.Table, blocks: pa.Table) -> pa.Table:
    out = {c: docs.column(c).combine_chunks().flatten() for c in _SPILL.names[4:]}
    total, top = np.zeros((2, len(out["doc_id"])), np.int64)
    for block in blocks.column("block"):
        step, a, b = unpacked(block.as_py())
        at = np.cumsum(step)
        total[at] += a
        top[at] += b
    return pa.table({
        "doc_id": out["doc_id"], **{c: out[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
        "n_best": pa.array(top, pa.int64()), "count_sum": pa.array(total, pa.int64()),
        "groups_sha256": out["digest"], "groups": out["groups"]})


def _radix(b):
    """``radix_of`` as an expression."""
    return F.pmod(F.shiftright(b * F.lit(0x9E3779B1), 12), F.lit(RADIX)).cast("int")


class Alignment:
    """The spilled runs of a corpus, its pair counts, and the documents' results."""

    def __init__(self, docs: DataFrame, tokenizer: str | None = None, pieces: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False):
        prepare(docs.sparkSession, batch_rows=256)
        self.keep_groups = keep_groups
        narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                             F.col(text_col).cast("string").alias("text"))
        self.spilled = staged(narrow.mapInArrow(_spill(
            tokenizer or default_tokenizer(), pieces or default_pieces(), keep_groups), SPILL),
            "alignment")
        # Two numbers for each of the fixed number of parts decide how many tasks share it.
        sizes = {r["radix"]: r for r in self.spilled.where("radix >= 0").groupBy("radix").agg(
            F.sum(F.length("pairs") + F.length("docs")).alias("bytes"),
            F.count(F.lit(1)).alias("runs")).collect()}
        self.splits = F.array(*(F.lit(max(-(-r["bytes"] // PART_BYTES), -(-r["runs"] // PART_RUNS))
                                      if (r := sizes.get(k)) else 1) for k in range(RADIX)))
        self.runs = self.spilled.where("radix >= 0").withColumn("split", F.pmod(
            F.xxhash64("chunk"), F.get(self.splits, F.col("radix"))).cast("int"))
        self.totals = staged(
            self.runs.select("radix", "split", "pairs").repartition("radix", "split")
            .sortWithinPartitions("radix", "split").mapInArrow(_count, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")

    def pairs(self) -> DataFrame:
        """a, b, n and whether n is the highest of its B id, for every linked pair of ids."""
        rows = self.totals.select(
            F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)).cast("int").alias("a"),
            F.shiftright("pair", ID_BITS).cast("int").alias("b"), "n")
        most = rows.groupBy("b").agg(F.max("n").alias("most"))
        return rows.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))

    def documents(self) -> DataFrame:
        """A row for each document: its counts, the digest of its groups, and the groups if kept."""
        totals = self.totals.withColumn("radix", _radix(F.shiftright("pair", ID_BITS))).withColumn(
            "split", F.explode(F.sequence(F.lit(0), F.get(self.splits, F.col("radix")).cast("int") - 1)))
        blocks = self.runs.select("radix", "split", "chunk", "pairs", "docs").groupBy(
            "radix", "split").cogroup(totals.groupBy("radix", "split")).applyInArrow(
            _contribute, "chunk long, block binary")
        docs = self.spilled.where("radix < 0").select("chunk", *_SPILL.names[4:])
        out = docs.groupBy("chunk").cogroup(blocks.groupBy("chunk")).applyInArrow(
            _finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                     "count_sum long, groups_sha256 string, groups string")
        return out if self.keep_groups else out.drop("groups")


def align_documents(docs: DataFrame, **options) -> DataFrame:
    return Alignment(docs, **options).documents()
