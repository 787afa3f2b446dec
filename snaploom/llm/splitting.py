"""Cutting texts over a token limit into pieces, at natural boundaries where there are any.

Prefix sums give the token offset of every word, and each kind of boundary
(paragraph, line, sentence, word) has a sorted array of those offsets. A binary
search finds the last boundary within the limit; the strongest kind whose last
boundary fills at least half of the limit wins. Without any boundary the cut is
hard, between two tokens. The next piece steps back by the overlap, counted in
tokens of the document, and a bit further where a token ends inside a character.
A piece that starts or ends inside a word is encoded again, and shortened
should its own tokens be more than the limit.

Defined results: null, blank and short texts, and those of sources without a
limit, give no pieces; a null limit is none, and of several limits of a source the smallest counts; any overlap below the limit is
kept, and a longer one is one token less than it, so that every piece adds text;
the limit goes before the overlap where both can't be had, as a piece from
inside a word may have more tokens of its own; all pieces together cover
the whole text, and a single character longer than the limit is one piece;
repeated documents are cut each; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaploom.llm import bpe
from snaploom.llm.encoding import TOKENIZERS, shared_vocabulary

KINDS = ("word", "sentence", "line", "paragraph")
# fixed values: marks that end a sentence, and those that may close after one
ENDS = np.array([ord(c) for c in ".!?…。！？｡։؟۔।"], np.uint32)
CLOSES = np.array([ord(c) for c in "\"')]}»”’」』）"], np.uint32)
WIDE_ENDS = np.array([ord(c) for c in "。！？｡"], np.uint32)
SCHEMA = "source string, piece_no int, start_char bigint, end_char bigint, start_token bigint, end_token bigint, boundary string, piece string"


def boundary_kinds(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word: the kind of boundary before it (index of ``KINDS``), or -1. White space belongs to what precedes it."""
    n = len(starts) - 1
    kinds = np.full(n, -1, np.int8)
    if n < 2:
        return kinds
    space = bpe._classes()[points] == bpe.SPACE
    breaks = np.concatenate([[0], np.cumsum((points == 10) | (points == 0x2028))])
    breaks2 = np.concatenate([[0], np.cumsum(points == 0x2029)])
    at = starts[:-1]
    ends_space = space[starts[1:] - 1]  # a word that ends with white space is white space throughout
    before, before2 = np.roll(ends_space, 1), np.roll(ends_space, 2)
    before[:1], before2[:2] = False, False
    run_start = np.where(before & before2, np.roll(at, 2), np.where(before, np.roll(at, 1), at))
    lines, paragraphs = breaks[at] - breaks[run_start], breaks2[at] - breaks2[run_start]
    last = np.maximum(run_start - 1, 0)
    prior = np.maximum(last - 1, 0)
    ended = np.isin(points[last], ENDS) | (np.isin(points[last], CLOSES) & np.isin(points[prior], ENDS))
    gap = before | space[at]
    kinds[gap] = 0
    kinds[np.isin(points[last], CLOSES) | (bpe._classes()[points[last]] == bpe.OTHER)] = 0
    kinds[ended & (gap | np.isin(points[last], WIDE_ENDS))] = 1
    kinds[lines == 1] = 2
    kinds[(lines > 1) | (paragraphs > 0)] = 3
    kinds[ends_space] = -1
    kinds[0] = -1
    return kinds


class _Text:
    """One text of a slice: its words, the tokens before each, and where tokens inside a word end."""

    def __init__(self, words: bpe.Words, kinds: np.ndarray, index: int):
        a, b = words.text_words[index], words.text_words[index + 1]
        self.words, self.base = words, int(words.text_points[index])
        self.starts = words.starts[a : b + 1].copy()
        self.starts[-1] = words.text_points[index + 1]
        self.slots = words.slot[a:b]
        self.tokens = np.concatenate([[0], np.cumsum(words.counts[a:b])])
        own = kinds[a:b].copy()
        if len(own):
            own[0] = -1
        self.sorted = [self.tokens[:-1][own >= k] for k in range(len(KINDS))]
        self.exact = [self.tokens[:-1][own == k] for k in range(len(KINDS))]

    def _inside(self, word: int, size: bool = False) -> np.ndarray:
        """Number of characters of ``word`` after each of its tokens; -1 where a character isn't complete."""
        slot = self.slots[word]
        ids = self.words.flat[self.words.offsets[slot] : self.words.offsets[slot + 1]]
        ends = np.cumsum(self.words.encoder.id_bytes[ids])
        text = self.words.word_text(self.starts[word], self.starts[word + 1])
        sizes = np.cumsum([len(c.encode()) for c in text])
        place = np.searchsorted(sizes, ends)
        return np.where(sizes[np.minimum(place, len(sizes) - 1)] == ends, place + 1, -1)

    def point(self, token: int) -> int:
        """The character at which ``token`` starts, or -1 if that is inside of one."""
        word = int(np.searchsorted(self.tokens, token, "right")) - 1
        if word >= len(self.slots):
            return int(self.starts[-1])
        into = token - int(self.tokens[word])
        if not into:
            return int(self.starts[word])
        chars = int(self._inside(word)[into - 1])
        return -1 if chars < 0 else int(self.starts[word]) + chars

    def is_word(self, token: int) -> bool:
        at = int(np.searchsorted(self.tokens, token))
        return at < len(self.tokens) and self.tokens[at] == token

    def cut(self, start: int, limit: int, least: int) -> tuple[int, str]:
        """The token at which the piece from ``start`` ends, and the kind of boundary there."""
        last = int(self.tokens[-1])
        if last - start <= limit:
            return last, "end"
        most = start + limit
        for floor in (start + max(limit // 2, least), start + least):
            for k in range(len(KINDS) - 1, -1, -1):
                at = int(np.searchsorted(self.sorted[k], most, "right")) - 1
                if at >= 0 and self.sorted[k][at] > floor:
                    return int(self.sorted[k][at]), KINDS[k]
        end = most
        while end > start + least and self.point(end) < 0:
            end -= 1
        if end <= start + least or self.point(end) < 0:  # one character is more than all the room
            end = most + 1
            while self.point(end) < 0:
                end += 1
        return end, "hard"

    def pieces(self, limit: int, overlap: int) -> Iterator[tuple[int, int, int, int, str]]:
        """(start token, end token, start character, end character, boundary) of each piece."""
        start, before, last = 0, 0, int(self.tokens[-1])
        overlap = max(0, min(overlap, limit - 1))
        while True:
            found = None
            while found is None:
                known = before - start  # tokens of the piece that the one before has too
                found = self._fitting(start, limit, max(overlap, known)) or self._fitting(start, limit, known)
                if found is None and not known:  # one character longer than the limit
                    found = self.cut(start, 1, 0)
                if found is None:  # the limit goes before the overlap
                    start = self._next_point(start)
            end, kind = found
            yield start, end, self.point(start) - self.base, self.point(end) - self.base, kind
            if end >= last:
                return
            after = end - overlap
            while after > start and self.point(after) < 0:
                after -= 1
            start, before = after if after > start else min(self._next_point(start), end), end

    def _next_point(self, token: int) -> int:
        token += 1
        while self.point(token) < 0:
            token += 1
        return token

    def _fitting(self, start: int, limit: int, least: int) -> tuple[int, str] | None:
        """The end of the piece from ``start`` that is longer than ``least`` and within the limit on its own, if there is one."""
        room = limit
        while room > least:
            end, kind = self.cut(start, room, least)
            if self.is_word(start) and self.is_word(end):
                size = end - start
            else:
                size = self.words.encoder.count(self.words.word_text(self.point(start), self.point(end)))
            if size <= limit:
                return end, kind
            room = max(room - (size - limit), least + 1) if room > least + 1 else least
        return None


def pieces(documents: DataFrame, limits: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, piece_no, start_char, ...) of every document over its source's limit."""
    vocabulary = shared_vocabulary(documents.sparkSession, tokenizers)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder_of(vocabulary.value)
        for batch in batches:
            for part in bpe.slices(batch, "text"):
                words = encoder.words(part.column("text"))
                totals = words.totals()
                kinds = boundary_kinds(words.points, words.starts)
                rows, keys = [], []
                bounds = zip(*(part.column(c).to_pylist() for c in ("source", "max_tokens", "overlap_tokens")))
                for i, (source, limit, overlap) in enumerate(bounds):
                    if limit is None or limit < 1 or totals[i] <= limit:
                        continue
                    text = _Text(words, kinds, i)
                    for n, (a, b, x, y, kind) in enumerate(text.pieces(limit, overlap or 0)):
                        rows.append((source, n, x, y, a, b, kind, words.word_text(text.base + x, text.base + y)))
                        keys.append(i)
                cols = list(zip(*rows)) if rows else [[]] * 8
                types = [pa.string(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.string()]
                out = [part.column("doc_id").take(pa.array(keys, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types))]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", *(f.split()[0] for f in SCHEMA.split(", "))])

    limit = limits.select(F.col("source_name").alias("of_source"), F.struct("max_tokens", "overlap_tokens").alias("bound")).where("of_source is not null and bound.max_tokens is not null").groupBy("of_source").agg(F.min("bound").alias("bound")).select("of_source", "bound.*")
    rows = documents.select("doc_id", "source", "text").join(limit, F.col("source") == F.col("of_source")).select("doc_id", "source", "max_tokens", "overlap_tokens", "text")
    # a text never has more tokens than bytes: shorter ones need no look
    long_enough = rows.where(F.octet_length("text") > F.col("max_tokens"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *T._parse_datatype_string(SCHEMA).fields])
    return long_enough.mapInArrow(split, schema)
