"""Token ids of texts, piece by piece, as the tokenizer's library gives them.

Where a tokenizer's normaliser and pre-tokeniser never join characters across an ASCII space, tab or line
end, and cut between an ASCII letter and one of `.,;:!?`, a text's ids are those of its pieces, one after
another. Then an Arrow batch is cut into pieces at once, and the library is asked for each distinct piece
that a worker has not met yet. `splits` finds out by trial whether a tokenizer is of that kind; the texts
of any other are encoded whole.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa

from .common import Remembered, byte_classes, pieces_of, worker_cache

CLASSES = byte_classes(b" \t\n\r", bytes(range(65, 91)) + bytes(range(97, 123)), b".,;:!?")
#: Lower-case letters of one code point each that no normalisation changes.
_LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
_LETTER_SET = frozenset(_LETTERS)
_PROBES = (
    "Hello World, it is.\nNew  line\tand a tab\r\nend", " leading and trailing ", "one;two:three!four?five.six,seven",
    "it's we'll I'd 'quoted' don't", "x1y2 3.14 1,000 (a) [b] {c} <d> a_b", "Ça été où Ñandú Straße ÀÉ", "...!? ,; a. b",
    "e\u0301 a\u0308. \u0301x", "日本 語。テスト", "a\u00a0b\u3000c", "https://x.org/a?b=c;d", "ABC.DEF Ghi,jkl",
)


def load(path: str):
    """The library's tokenizer, without truncation or padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def splits(t) -> bool:
    """Whether the ids of a text are those of its pieces: tried on texts with every kind of boundary, and
    no added token may hold a gap, eat the gaps around it or ask for a boundary."""
    if any(a.lstrip or a.rstrip or a.single_word or set(a.content) & set(" \t\n\r") for a in t.get_added_tokens_decoder().values()):
        return False
    ask = lambda piece: t.encode(piece, add_special_tokens=False).ids
    for text in _PROBES:
        codes, _, values = pieces_of(pa.array([text]), CLASSES)
        values = [v.decode() for v in values.to_pylist()]
        if ask(text) != [i for c in codes for i in ask(values[c])]:
            return False
    return True


class Encoder:
    """Ids of whole Arrow columns of texts. Ids are kept in 16 bits where the vocabulary allows it."""

    def __init__(self, path: str):
        self.library = load(path)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.by_piece = splits(self.library)
        self.letters = self._letters()
        self.tokenize = self.library.model.tokenize
        self.memo = Remembered(self._ids)

    def _letters(self) -> dict[int, str] | None:
        """How the model spells lower-case letters, if a word of them is one pre-token as it is."""
        t = self.library
        if not t.normalizer or not t.pre_tokenizer or not self.by_piece:
            return None
        if t.normalizer.normalize_str(_LETTERS) != _LETTERS or len(t.pre_tokenizer.pre_tokenize_str(_LETTERS)) != 1:
            return None
        table = {ord(c): t.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LETTERS}
        words = [_LETTERS, _LETTERS[::-1], "a", "Hello", "straße", "ÀÉ", "NEW"]
        same = all(t.encode(w, add_special_tokens=False).ids == [x.id for x in t.model.tokenize(w.lower().translate(table))] for w in words)
        return table if same and all(s == chr(c) for c, s in table.items() if c < 128) else None

    def ids(self, piece: str) -> list[int]:
        if self.letters and piece:
            low = piece.lower()
            if _LETTER_SET.issuperset(low):
                return [x.id for x in self.tokenize(low if low.isascii() else low.translate(self.letters))]
        return self.library.encode(piece, add_special_tokens=False).ids

    def _ids(self, piece: bytes) -> bytes:
        return array(self.code, self.ids(piece.decode())).tobytes()

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by `end`, one after another; and where each text's start and
        the last one's end."""
        if not self.by_piece:
            found = [[*self.library.encode(t, add_special_tokens=False).ids, end] for t in texts.to_pylist()]
            return np.array([i for f in found for i in f], self.kind), np.cumsum([0, *map(len, found)])
        codes, bounds, values = pieces_of(texts, CLASSES)
        spelled = [*map(self.memo.__getitem__, values.to_pylist()), np.array([end], self.kind).tobytes()]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) // self.kind.itemsize
        vocabulary = np.frombuffer(b"".join(spelled), self.kind)
        codes = np.insert(codes, bounds[1:], len(spelled) - 1)
        n = sizes[codes]
        ends = np.cumsum(n)
        first = np.cumsum(sizes) - sizes
        count = int(ends[-1]) if len(ends) else 0
        at = np.repeat((first[codes] - ends + n).astype(np.int32 if count < 1 << 30 and len(vocabulary) < 1 << 30 else np.int64), n)
        at += np.arange(count, dtype=at.dtype)
        ids = vocabulary[at]
        return ids, np.append(0, ends[bounds[1:] + np.arange(len(texts))])


def encoder(owner: str, path: str) -> Encoder:
    return worker_cache(owner, f"encoder {path}", lambda: Encoder(path))
