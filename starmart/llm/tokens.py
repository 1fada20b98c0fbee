"""Token ids of whole texts with the tokenizers library, inside tasks.

A byte-level pre-tokenizer never lets a piece cross from a visible character
to a space, so a text may be cut before each space and its words encoded one
by one. Words repeat, so their ids are kept in a bounded store of the worker.
Texts where a space is followed by more white space, or by the end, could
lose a piece to such a cut and go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker keeps in each of two generations (about 200 bytes a word).
#: More of them save encoding, fewer leave memory to a pipeline's other stages.
STORE, LARGE_STORE = 150_000, 1_000_000
#: Characters whose ids are laid out together, unless one text has more.
AT_ONCE = 4_000_000
#: Line ends up to which a stretch without spaces is cut (each is one more call).
MOST_LINES = 50
_RUN = re.compile(r" (?:\s|\Z)")
#: Marks that end a word's letters and form one piece of their own. An apostrophe
#: is not among them: it may open a contraction.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves; the others follow from 256.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Ids (as bytes) of words that follow ``lead``; the library is asked for new ones."""

    def __init__(self, tok, kind, lead: str, bare: Words | None = None,
                 older: dict | None = None):
        super().__init__()
        self.bare = self if bare is None else bare
        self.tok, self.kind, self.lead, self.older = tok, kind, lead, older or {}
        self.model, self.alphabet = tok.model, byte_alphabet()
        self.head = "".join(self.alphabet[b] for b in lead.encode())
        self.marks: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word.isalpha():  # one piece, which goes straight to the merges
                piece = word if word.isascii() else word.encode().decode("latin-1").translate(
                    self.alphabet)
                ids = array(self.kind, [t.id for t in self.model.tokenize(
                    self.head + piece)]).tobytes()
            else:
                left, line, right = word.partition("\n")
                if (line and left and right and not left[-1].isspace() and not right[0].isspace()
                        and word.count("\n") <= MOST_LINES):
                    # A lone line end is a piece; what follows it has no space before it.
                    return self[left] + self.tail("\n") + self.bare[right]
                core = word.rstrip(_MARKS)
                if core.isalpha():  # letters and their marks are two pieces
                    ids = self[core] + self.tail(word[len(core):])
                else:
                    ids = self.whole(self.lead + word)
        self[word] = ids
        return ids

    def tail(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[marks] = self.whole(marks)
        return self.marks[marks]

    def whole(self, text: str) -> bytes:
        return array(self.kind, self.tok.encode(text, add_special_tokens=False).ids).tobytes()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        # A special token's string inside a text is ordinary text.
        self.tok.encode_special_tokens = True
        self.store = STORE
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.kind = "H" if self.size <= 65536 else "I"
        self.first = Words(self.tok, self.kind, "")
        self.later = Words(self.tok, self.kind, " ", self.first)

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for null or empty ones."""
        out, i, size = [], 0, 0
        for j, t in enumerate(texts):
            if size and size + len(t or "") > AT_ONCE:
                out, i, size = out + self._lay(texts[i:j]), j, 0
            size += len(t or "")
        return out + self._lay(texts[i:])

    def _lay(self, texts: list[str | None]) -> list[np.ndarray]:
        """Looks the texts' distinct words up once and lays out their ids at every place."""
        whole = [bool(t) and _RUN.search(t) is not None for t in texts]
        cut = pc.split_pattern(pa.array(["" if w else t or "" for t, w in zip(texts, whole)],
                                        pa.large_string()), " ")
        ends = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy().copy()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.later.__getitem__, words))
        # The first word of a text follows no space; it has entries of its own.
        firsts = at[ends[:-1]]
        distinct, own = np.unique(firsts, return_inverse=True)
        at[ends[:-1]] = len(found) + own
        found += [self.first[words[i]] if words[i] else b"" for i in distinct]
        found += [self.first.whole(t) for t, w in zip(texts, whole) if w]
        at[ends[:-1][whole]] = np.arange(len(found) - sum(whole), len(found))
        ids = np.frombuffer(b"".join(found), self.kind)
        size = np.fromiter(map(len, found), np.int32, len(found)) // ids.itemsize
        start = np.cumsum(size) - size
        sizes = size[at]
        stop = np.cumsum(sizes)
        total = int(stop[-1]) if len(stop) else 0
        kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
        place = np.repeat((start[at] - (stop - sizes)).astype(kind), sizes)
        place += np.arange(total, dtype=kind)
        laid = ids.take(place)
        bounds = np.append(0, stop)[ends]
        if len(self.first) > self.store:
            self.first = Words(self.tok, self.kind, "", None, dict(self.first))
            self.later.bare = self.first
        if len(self.later) > self.store:
            self.later = Words(self.tok, self.kind, " ", self.first, dict(self.later))
        return [laid[i:j] for i, j in zip(bounds[:-1], bounds[1:])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str, store: int = STORE) -> Encoder:
    """This worker's encoder for the vocabulary file at ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].store = store
    return _encoders[path]


def release(path: str) -> None:
    """Give up the words that this worker keeps; a later task starts anew."""
    _encoders.pop(path, None)
