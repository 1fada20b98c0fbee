"""Cross-tokenizer alignment against a plain loop over all token pairs."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starmart.llm import alignment
from starmart.llm.alignment import Alignment, align_documents, merge_directories, run_of

TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
TOK.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
BACK = {c: b for b, c in alignment.byte_alphabet().items()}

TEXTS = [
    "The quick brown fox, the lazy dog.", None, "", " ", "two  spaces and a tail ", "line\nends\n\nhere\n x",
    "naïve café — déjà vu 😀😀", "mark ▁ inside", "<|endoftext|> and <s> and <unk> <0x0A>", "a\x00b tab\there",
    "The quick brown fox, the lazy dog.", "x" * 3000, "word\n" * 400 + "end", "the the the " * 900 + "the",
    "日本語のテキスト です", "  odd　spaces\r\n"]


def tokens(text):
    if not text:
        return None
    raw = (" " + text).encode()
    a = [(i, bytes(BACK[c] for c in TOK.id_to_token(i)))
         for i in TOK.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(SP.id_to_piece(i)[3:5], 16)]) if SP.is_byte(i) else
          SP.id_to_piece(i).replace("▁", " ").encode()) for i in SP.encode(text)]
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return None
    return a, b


def spans(toks):
    at, out = 0, []
    for i, x in toks:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(rows):
    links, groups = [], []
    for _, text in rows:
        ab = tokens(text)
        if ab is None:
            links.append(None)
            groups.append("")
            continue
        a, b = map(spans, ab)
        links.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]])
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        parts, low = [], 0
        for high in ends:
            parts.append("|".join(",".join(str(t[0]) for t in s if low < t[2] <= high) for s in (a, b)))
            low = high
        groups.append(";".join(parts))
    count = Counter(x for ls in links if ls for x in ls)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (doc_id, text), ls, g in zip(rows, links, groups):
        if ls is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = tokens(text)
        out.append((doc_id, len(a), len(b), g.count(";") + 1, len(ls),
                    sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls),
                    hashlib.sha256(g.encode()).hexdigest()))
    return out, count


def key(r):
    return tuple((x is None, x) for x in r)


SCHEMA = "doc_id long, text string, pair string, chunk int"


def test_against_all_pairs(spark):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (0, "other text")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    al = Alignment(df, keep_groups=True)
    got = al.documents()
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256", "groups"]
    want, count = brute(rows)
    found = got.collect()
    assert sorted((tuple(r)[:8] for r in found), key=key) == sorted(want, key=key)
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"]
               for r in found if r["groups"])
    pairs = al.pairs().collect()
    assert {(r["a"], r["b"]): r["n"] for r in pairs} == dict(count)


def test_small_chunks_and_split_parts(spark, monkeypatch):
    """Many chunks, every part dealt over several tasks, merges of two runs."""
    for name, value in (("CHUNK_RECORDS", 40), ("PART_RUNS", 2), ("FAN_IN", 2)):
        monkeypatch.setattr(alignment, name, value)
    rows = [(i, TEXTS[i % 8]) for i in range(40)]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in align_documents(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows)[0], key=key)


def test_empty_table(spark):
    assert align_documents(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("abc eé\n\t ▁😀.,'1&& \r　sS")), max_size=40))
def test_cut_equals_whole(text):
    al = alignment.aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    chunk = alignment.Chunk(0)
    alignment._gather(al, chunk, [1], [text], True)
    e = al.whole([text])[0] if text else None
    want = (*e[:3], len(e[3]) // 8) if e else (0, 0, 0, 0)
    assert chunk.docs[0][1:5] == want and chunk.docs[0][6] == (e[4] if e else "")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 1 << 38), st.integers(0, 9), st.integers(1, 600)),
                         min_size=1), min_size=1, max_size=6))
def test_merge_of_runs(runs):
    import numpy as np
    count, parts = Counter(), []
    for run in runs:
        c = Counter()
        for p, d, n in run:
            c[p, d] += n
            count[p] += n
        cols = np.array([(p, d, n) for (p, d), n in sorted(c.items())], np.int64).T
        parts.append(run_of(*cols)[0])
    assert list(merge_directories(parts)) == sorted(count.items())


def test_ids_beyond_the_record(monkeypatch):
    monkeypatch.setattr(alignment, "ID_BITS", 4)
    with pytest.raises(ValueError):
        alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def fresh():
    return alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


class Counting:
    """A library that counts the texts it is asked for."""

    def __init__(self, library, method):
        self.library, self.method, self.texts = library, method, 0

    def __getattr__(self, name):
        def call(texts, **options):
            self.texts += len(texts) if name == self.method else 0
            return getattr(self.library, name)(texts, **options)
        return call


def test_new_words_are_encoded_side_by_side():
    """The libraries are asked for a hundred new words at once, not for each (1431 CPU seconds a GB)."""
    al = fresh()
    al.a, al.b = Counting(al.a, "encode_batch_fast"), Counting(al.b, "encode")
    words = [f"word{i}x" for i in range(2000)] + ["plain,", "a\nb", "▁", "x▁y"]
    found = al.lookup(words)
    # Twenty-one blocks; a comma, a line end, a word behind one, and two that hold a mark of B.
    assert al.a.texts == al.b.texts == 21 + 5
    assert found == [alignment.joined(e) if None not in e else None for e in (
        [fresh_entry(x if k else " " + x) for k, x in enumerate(al.cut(w))] for w in words)]


_alone = fresh()


def fresh_entry(stretch):
    return _alone.encoded([stretch], 1)[0]


def test_a_word_that_its_tokens_do_not_spell_costs_no_other():
    al = fresh()
    al.bytes_b[SP.piece_to_id("▁the")] = b"?"
    words = ["of", "the", "quick", "other", "then"]
    assert [e is None for e in al.lookup(words)] == [w == "the" for w in words]
    assert [e for e in al.lookup(words) if e] == [fresh_entry(" " + w) for w in words if w != "the"]


def test_stretches_that_a_token_goes_on_over(monkeypatch):
    """Where a token lies over the end of a stretch, stretches are encoded one by one."""
    al, sides, whole = fresh(), [], alignment.Aligner.entries

    def entries(self, ids_a, ids_b, stop):
        sides.append(len(stop))
        return whole(self, ids_a, ids_b, stop - [1, 0, 0] if len(sides) == 1 else stop)
    monkeypatch.setattr(alignment.Aligner, "entries", entries)
    words = ["quick", "brown", "foxes"]
    assert al.lookup(words) == [fresh_entry(" " + w) for w in words]
    assert sides[0] == 3 and len(sides) > 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abcdehnorst é日😀.,'1&\x00sS")), min_size=1, max_size=12),
                min_size=1, max_size=8, unique=True), st.integers(1, 60))
def test_entries_against_all_pairs(words, at_once):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(alignment, "AT_ONCE", at_once)
        for w, e in zip(words, _alone.encoded([" " + w for w in words], 1 if " " in "".join(words) else 3)):
            (_, n_a, n_b, n_groups, n_links, _, _, digest), = brute([(0, w)])[0]
            count = brute([(0, w)])[1]
            assert e[:3] == (n_a, n_b, n_groups)
            assert hashlib.sha256(e[4].encode()).hexdigest() == digest
            pairs = [divmod(int.from_bytes(e[3][k:k + 8], "little"), 1 << alignment.ID_BITS)
                     for k in range(0, len(e[3]), 8)]
            assert len(pairs) == n_links and Counter((a, b) for b, a in pairs) == count
