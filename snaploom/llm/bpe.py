"""Byte-pair encoding of whole texts with a public byte-level vocabulary.

Texts are handled a slice at a time, as one array of code points: the split
into words follows from character classes at neighbouring positions, so it
takes a few array operations rather than a search. Distinct words are encoded
together by a pair occurrence index: every adjacent pair with a merge rank maps
to all its positions, active ranks are applied in ascending order, and only the
lists of pairs next to a merge are updated. A merge only makes pairs of higher
rank, as those name a symbol that the merge made. Words already encoded by this
worker are looked up; that memory is emptied when it reaches ``REMEMBERED``
words, which changes no result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa

REMEMBERED = 400_000
SLICE_BYTES = 4 << 20
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# fixed values: code points with Unicode's White_Space property
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# fixed values: the endings that an apostrophe keeps
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def _classes() -> np.ndarray:
    category = unicodedata.category
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.frombuffer(bytes(kinds.get(category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8).copy()
    table[list(WHITE_SPACE)] = SPACE
    return table


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


@lru_cache(2)
def token_bytes(vocabulary: bytes) -> list[bytes]:
    """The bytes of each token, by id; none for ids that the file gives to special tokens."""
    of = {c: b for b, c in enumerate(byte_symbols())}
    ids = json.loads(vocabulary)["model"]["vocab"]
    out = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        if all(c in of for c in token):
            out[i] = bytes(of[c] for c in token)
    return out


def word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which positions start a word; ``first`` marks the first position of each text."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = _classes()[points]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # a non-space after white space: its word takes a plain space before it; other white space stays alone
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:]) + 1
    plain = points[after - 1] == 0x20
    start[after - 1] = True
    start[after[plain]] = False
    # an apostrophe that starts a word takes one of the endings, wherever the letters go on
    at = np.flatnonzero((points == 0x27) & start)
    at = at[at + 1 < n]
    at = at[~first[at + 1]]
    if len(at):
        padded = np.append(points[at[0] :], np.zeros(2, points.dtype))
        one, two = padded[at - at[0] + 1], padded[at - at[0] + 2]
        two = np.where(np.append(first, [True, True])[at + 2], 0, two)
        length = np.zeros(len(at), np.int64)
        for ending in ENDINGS:
            hit = (one == ord(ending[0])) & (length == 0)
            if len(ending) == 2:
                hit &= two == ord(ending[1])
            length[hit] = len(ending)
        at, length = at[length > 0], length[length > 0]
        start[at + 1] = False
        end = at + 1 + length
        start[end[end < n]] = True
    return start


class Encoder:
    """Encodes with the merges of a byte-level vocabulary file (the JSON form)."""

    def __init__(self, vocabulary: bytes):
        told = json.loads(vocabulary)
        cut = told.get("pre_tokenizer") or {}
        # the words that word_starts finds are those of this kind of file only
        if told.get("normalizer") is not None or (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) != ("ByteLevel", False, True):
            raise ValueError("the vocabulary's texts are cut into words by other rules than those of byte-level files")
        model = told["model"]
        ids = model["vocab"]
        self.byte_ids = [ids[s] for s in byte_symbols()]
        #: (left id, right id) as one number -> rank; by rank: left, right and merged id
        self.ranks: dict[int, int] = {}
        self.left, self.right, self.merged = [], [], []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(ids[a] << 32 | ids[b], rank)
            self.left.append(ids[a])
            self.right.append(ids[b])
            self.merged.append(ids[a + b])
        #: number of bytes of each id
        self.id_bytes = np.zeros(max(ids.values()) + 1, np.int64)
        for symbols, i in ids.items():
            self.id_bytes[i] = len(symbols)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.offsets = np.zeros(1 << 16, np.int64)

    def _merge_all(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Symbols of all words in a row after all merges (-1: merged away), and where each word starts."""
        byte_ids, ranks, left, right, merged = self.byte_ids, self.ranks, self.left, self.right, self.merged
        begins, symbols, positions = [], [], {}
        for w in words:
            begins.append(len(symbols))
            symbols.extend([byte_ids[b] for b in w])
            symbols.append(-2)  # no pair reaches over it
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        get = ranks.get
        for i in range(len(symbols) - 1):
            a, b = symbols[i], symbols[i + 1]
            if a >= 0 and b >= 0:
                r = get(a << 32 | b)
                if r is not None:
                    if r in positions:
                        positions[r].append(i)
                    else:
                        positions[r] = [i]
        active = list(positions)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            a, b, m = left[r], right[r], merged[r]
            for i in sorted(positions.pop(r)):
                j = after[i]
                if symbols[i] != a or symbols[j] != b:
                    continue  # one of the two has gone into another merge
                symbols[i], symbols[j] = m, -1
                k = after[j]
                after[i] = k
                before[k] = i
                c = symbols[k]
                if c >= 0:
                    q = get(m << 32 | c)
                    if q is not None:
                        if q in positions:
                            positions[q].append(i)
                        else:
                            positions[q] = [i]
                            heapq.heappush(active, q)
                h = before[i]
                if h >= 0 and symbols[h] >= 0:
                    q = get(symbols[h] << 32 | m)
                    if q is not None:
                        if q in positions:
                            positions[q].append(h)
                        else:
                            positions[q] = [h]
                            heapq.heappush(active, q)
        return symbols, begins

    def _learn(self, words: list[bytes]) -> None:
        symbols, begins = self._merge_all(words)
        array = np.array(symbols, np.int32)
        kept = array >= 0
        count = np.concatenate([[0], np.cumsum(kept)])
        known = len(self.slots)
        base = self.offsets[known]
        ends = base + count[np.append(begins[1:], len(symbols)).astype(np.int64)]
        while known + len(words) + 1 > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.offsets[known + 1 : known + 1 + len(words)] = ends
        self.flat[base : ends[-1]] = array[kept]
        self.slots.update(zip(words, range(known, known + len(words))))

    def word_slots(self, words: list[bytes]) -> np.ndarray:
        """The slot of each of the distinct words; their ids are ``flat[offsets[slot]:offsets[slot + 1]]``."""
        if len(self.slots) + len(words) > REMEMBERED:
            self.forget()
        new = [w for w in words if w not in self.slots]
        if new:
            self._learn(new)
        slots = self.slots
        return np.fromiter((slots[w] for w in words), np.int64, len(words))

    def count(self, text: str) -> int:
        """Number of ids of one text."""
        return int(self.words(pa.array([text])).totals()[0])

    def words(self, texts: pa.Array) -> Words:
        return Words(self, texts)


class Words:
    """The words of the texts of one slice, and how each is encoded. Null texts have none."""

    def __init__(self, encoder: Encoder, texts: pa.Array):
        data, at, lengths = _utf8(texts)
        self.text_bytes = at
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        ascii_only = len(points) == len(data)
        if ascii_only:
            self.point_bytes = None
            text_points = at
        else:
            lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
            self.point_bytes = np.append(np.flatnonzero(lead), len(data))
            text_points = np.searchsorted(self.point_bytes, at)
        self.points, self.text_points, self.data = points, text_points, data
        first = np.zeros(len(points), bool)
        first[text_points[:-1][lengths > 0]] = True
        starts = np.flatnonzero(word_starts(points, first))
        #: code point at which each word starts, and the end of the last
        self.starts = np.append(starts, len(points))
        byte_starts = self.starts if ascii_only else self.point_bytes[self.starts]
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(byte_starts.astype(np.int32)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        distinct = encoder.word_slots(coded.dictionary.to_pylist())
        self.slot = distinct[coded.indices.to_numpy()] if len(starts) else np.zeros(0, np.int64)
        self.encoder = encoder
        # these stay as they are for this slice, even if the encoder forgets or grows
        self.flat, self.offsets = encoder.flat, encoder.offsets
        #: number of ids of each word; the first word of each text
        self.counts = self.offsets[self.slot + 1] - self.offsets[self.slot]
        self.text_words = np.searchsorted(starts, text_points)

    def word_text(self, a: int, b: int) -> str:
        """The text between two code points."""
        if self.point_bytes is not None:
            a, b = self.point_bytes[a], self.point_bytes[b]
        return self.data[a:b].decode("utf-8")

    def totals(self) -> np.ndarray:
        """Number of ids of each text."""
        sums = np.concatenate([[0], np.cumsum(self.counts)])
        return sums[self.text_words[1:]] - sums[self.text_words[:-1]]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the offsets of the texts in them."""
        sums = np.concatenate([[0], np.cumsum(self.counts)])
        where = np.repeat(self.offsets[self.slot] - sums[:-1], self.counts) + np.arange(sums[-1])
        return self.flat[where], sums[self.text_words]


def _utf8(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All bytes, the offset of each text and the end, and the texts' lengths; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = bytes(body[int(offsets[0]) : int(offsets[-1])]) if body is not None and len(offsets) else b""
    offsets = offsets - offsets[0]
    return data, offsets, np.diff(offsets)


def slices(batch: pa.RecordBatch, column: str) -> Iterable[pa.RecordBatch]:
    """The batch in parts of whole rows, each of about ``SLICE_BYTES`` of text or a single row."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // SLICE_BYTES
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(int(a), int(b - a))


@lru_cache(2)
def encoder_of(vocabulary: bytes) -> Encoder:
    return Encoder(vocabulary)
