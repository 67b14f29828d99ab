"""Exact token ids of public tokenizers, each distinct piece encoded once.

Texts are cut only where no token, pre-token or normalisation reaches across.
Pieces are found and told apart (64-bit hashes) with array operations over a
batch's bytes; new ones are encoded by the tokenizers library, several at a
time, and a document's ids are gathered from its pieces'. Texts with unusual
white space or special-token marks are encoded whole.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lakegraph.llm import store, words

CACHE_BYTES = 48 << 20          # of one generation of pieces
KEEP_BYTES = 8 << 20            # of pieces that an idle worker keeps
CHUNK_BYTES = 2 << 20
_BLOCK_CHARS = 1 << 13
# White space, letters of one byte and plain punctuation. A byte that is none
# of them is never a cut point, whatever character it belongs to.
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 13, 32]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[list(b".,;:!?|")] = True
_ODD = np.zeros(256, dtype=bool)
_ODD[[11, 12, 28, 29, 30, 31]] = True
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3, 0x3C]] = True


def _odd_rows(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows with white space beyond blank, tab and line ends, or with ``<|``."""
    odd = np.flatnonzero(_ODD[data])
    lead = np.flatnonzero(_LEAD[data[:-1]]) if len(data) > 1 else np.zeros(0, np.int64)
    a, b = data[lead], data[lead + 1] if len(lead) else data[:0]
    c = data[np.minimum(lead + 2, len(data) - 1)] if len(lead) else data[:0]
    hit = (a == 0x3C) & (b == 0x7C)
    hit |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (a == 0xE1) & (b == 0x9A)
    hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    hit |= (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8F)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    hit |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    at = np.concatenate([odd, lead[hit]])
    out = np.zeros(len(offs) - 1, dtype=bool)
    out[np.searchsorted(offs, at, side="right") - 1] = True
    return out


def pieces(data: np.ndarray, offs: np.ndarray, byte_level: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first piece of each row.

    Cuts of both kinds: between a letter and plain punctuation. Byte-level
    pre-tokens may take one blank in front: cuts before white space that
    follows none or is the last before other text, and behind other white
    space than a blank. Otherwise white space stands in no piece.
    """
    n = len(data)
    white = _WHITE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offs] = True
    after = np.zeros(n, dtype=bool)                     # white space before, in the row
    after[1:] = white[:-1]
    after &= ~first[:-1]
    letter = _LETTER[data]
    two = np.zeros(n, dtype=bool)                       # last byte of an accented Latin letter
    two[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter |= two
    cut = np.zeros(n, dtype=bool)
    cut[1:] = letter[:-1] & _PUNCT[data[1:]]
    begin = first[:-1].copy()
    begin |= cut
    if byte_level:
        ahead = np.zeros(n, dtype=bool)                 # other text next, in the row
        ahead[:-1] = ~white[1:]
        ahead &= ~first[1:]
        begin |= white & (~after | ahead)
        blank = np.zeros(n, dtype=bool)
        blank[1:] = data[:-1] == 32
        begin |= ~white & after & ~blank
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], n)
    else:
        begin |= after
        begin &= ~white
        starts = np.flatnonzero(begin)
        stop = np.ones(n, dtype=bool)
        stop[:-1] = white[1:] | begin[1:] | first[1:-1]
        ends = np.flatnonzero(stop & ~white) + 1
    return starts, ends, np.searchsorted(starts, offs)


class Pieces:
    """Ids of known pieces by hash, in a few flat arrays."""

    def __init__(self):
        self.keys = np.zeros(0, dtype=words.U64)
        self.start, self.many = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.uint32)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.keys, self.start, self.many, self.ids))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each key, whether it is known)."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), dtype=bool)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids one behind the other) of the pieces at these places."""
        many = self.many[at].astype(np.int64)
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return many, self.ids[np.repeat(self.start[at], many) + step]

    def add(self, keys: np.ndarray, many: np.ndarray, ids: np.ndarray) -> None:
        """New pieces, by rising key."""
        order = np.argsort(whole := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = whole[order]
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(many) - many])[order]
        self.many = np.concatenate([self.many, many.astype(np.int32)])[order]
        self.ids = np.concatenate([self.ids, ids])


class Encoder:
    """Ids of texts. Pieces live in two generations of bounded size: when the
    young one is full it becomes the old one, and pieces met again move up."""

    def __init__(self, path: str, byte_level: bool, end: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = byte_level
        self.tail = np.array([] if end is None else [end], dtype=np.uint32)
        vocab = self.tokenizer.get_vocab(True)
        # bytes behind a token: one per character, without the mark of a word's end
        self.bytes_of = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token) - (0 if byte_level or not token.endswith("</w>") else 4)
        self.young, self.old = Pieces(), Pieces()
        self.learned: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _put(self, piece: bytes, ids: bytes) -> None:
        self.learned[piece] = ids

    def _block(self, block: list[bytes], glue: bytes) -> None:
        """Encode pieces as one text and deal the ids out by the bytes they
        stand for. A line end between pieces is a byte-level token of its own;
        a blank between words is dropped."""
        ids = self._whole(glue.join(block).decode())
        skip = 1 if glue == b"\n" else 0
        size = np.cumsum(self.bytes_of[ids])
        want = np.cumsum([len(x) + skip for x in block]) - skip
        cut = np.searchsorted(size, want)
        if not len(ids) or cut[-1] != len(ids) - 1 or not np.array_equal(size[cut], want):
            half = len(block) // 2                      # bytes changed after all
            if half:
                self._block(block[:half], glue)
                self._block(block[half:], glue)
            else:
                self._put(block[0], ids.tobytes())
            return
        raw, before = ids.tobytes(), 0
        for x, c in zip(block, ((cut + 1) * 4).tolist(), strict=True):
            self._put(x, raw[before:c])
            before = c + 4 * skip

    def _glue(self, piece: bytes) -> bytes | None:
        """What may stand between the piece and others of its kind with all
        ids and byte counts unchanged; None where nothing may."""
        if self.byte_level:
            if piece[0] not in b"\t\n\r ":
                return b"\n"
            return b"" if piece[0] == 32 and len(piece) > 1 and piece[1] not in b"\t\n\r " else None
        if piece.isascii():
            return b" "
        text = piece.decode()
        return b" " if len(unicodedata.normalize("NFC", text).lower().encode()) == len(piece) else None

    def _learn(self, fresh: list[bytes]) -> None:
        blocks: dict[bytes, list[bytes]] = {}
        sizes: dict[bytes, int] = {}
        for x in fresh:
            glue = self._glue(x)
            if glue is None:
                self._put(x, self._whole(x.decode()).tobytes())
                continue
            blocks.setdefault(glue, []).append(x)
            sizes[glue] = sizes.get(glue, 0) + len(x)
            if sizes[glue] >= _BLOCK_CHARS:
                self._block(blocks.pop(glue), glue)
                sizes[glue] = 0
        for glue, block in blocks.items():
            self._block(block, glue)

    def _known(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Places of the distinct pieces (by rising key) among the young ones."""
        if self.young.nbytes > CACHE_BYTES:
            self.old, self.young = self.young, Pieces()
        at, known = self.young.find(keys)
        missing = np.flatnonzero(~known)
        if not len(missing):
            return at
        again, found = self.old.find(keys[missing])
        self.young.add(keys[missing[found]], *self.old.take(again[found]))
        missing = missing[~found]
        fresh = [data[a:b].tobytes() for a, b in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
        self._learn(fresh)
        got = [self.learned[x] for x in fresh]
        self.learned = {}
        self.young.add(keys[missing], np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4, np.frombuffer(b"".join(got), dtype=np.uint32))
        return self.young.find(keys)[0]

    def _rows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows with the tail behind each, and row offsets."""
        if not self.byte_level:
            data = words.LOWER[data]                    # as the tokenizer's normaliser does
        starts, ends, first = pieces(data, offs, self.byte_level)
        unique, at, of = np.unique(words.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        known = self._known(unique, starts[at], ends[at], data)
        flat, where, lens = self.young.ids, self.young.start[known], self.young.many[known].astype(np.int64)
        many = lens[of] if len(of) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(many)])
        n, k = len(offs) - 1, len(self.tail)
        rows = total[first] + k * np.arange(n + 1)
        out = np.empty(int(rows[-1]), dtype=np.uint32)
        row_of = np.repeat(np.arange(n), np.diff(first))
        place = np.repeat((total[:-1] + k * row_of).astype(np.int64), many) if len(of) else np.zeros(0, np.int64)
        step = np.arange(len(place)) - np.repeat(total[:-1], many)
        out[place + step] = flat[np.repeat(where[of], many) + step] if len(of) else 0
        if k:
            out[rows[1:] - 1] = self.tail[0]
        return out, rows

    def batches(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, ids of each row) over runs of a text column's rows."""
        for row, end, data, offs in words.chunks(column, CHUNK_BYTES):
            odd = _odd_rows(data, offs)
            if odd.any():
                keep = np.flatnonzero(~odd)
                lens = np.diff(offs)
                mask = np.repeat(~odd, lens)
                ids, cut = self._rows(data[mask], np.concatenate([[0], np.cumsum(lens[keep])]))
                out: list = [None] * (end - row)
                for i, (a, b) in zip(keep.tolist(), zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True), strict=True):
                    out[i] = ids[a:b]
                for i in np.flatnonzero(odd).tolist():
                    out[i] = np.concatenate([self._whole(data[offs[i]:offs[i + 1]].tobytes().decode()), self.tail])
            else:
                ids, cut = self._rows(data, offs)
                out = [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            yield row, out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, byte_level: bool, end: int | None = None) -> Encoder:
    """The encoder of this Python worker; ``release`` it at the end of a task."""
    key = (path, byte_level, end)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def release() -> None:
    """At the end of a task: encoders stay, but their pieces only while they are
    few, so that small tasks share them and an idle worker stays small."""
    for e in _ENCODERS.values():
        if e.young.nbytes + e.old.nbytes > KEEP_BYTES:
            e.young, e.old = Pieces(), Pieces()
    store.release()
