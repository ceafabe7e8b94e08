"""Packing of tokenised documents into windows by best-fit decreasing.

A document's ids, closed by one end id, are cut into full windows first; what is left over is one shorter piece. Best-fit
decreasing places pieces from long to short, each into the open window with the least remaining capacity that still holds
it. Only lengths matter to that rule, and there are at most ``width`` of them, so the pieces are counted by length (a table
of at most ``width`` rows), and the rule runs over the counts: a segment tree indexed by remaining capacity finds the
tightest open capacity, and all windows of that capacity take their pieces in one step. The outcome is the one of the rule
run piece by piece over the whole corpus, at a cost that does not grow with it. Every piece then finds its place from its
length and its number among the pieces of that length (``exact_row_number``: a length that a third of all pieces share is
spread over many tasks).

Ids come from the tokenizers library, for a vocabulary of byte-level merges with word ends and lower case. White space never
reaches an id of such a vocabulary, so a text's ids are those of its words one after the other: distinct words are encoded
once and looked up. At ``MEMO_WORDS`` words or ``MEMO_BYTES`` bytes the words known become the past, which is still asked,
and what was past before goes.

Defined cases: null and empty texts, and texts of white space only, are one piece that holds the end id alone; repeated
rows are documents of their own; a null doc_id stays null; extra columns are ignored; an empty table packs into no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import staged, whole_text
from lectern.operators.numbering import exact_row_number

WIDTH = 2048
END_ID = 1
CHUNK_BYTES = 1 << 21
MEMO_WORDS, MEMO_BYTES = 400_000, 1 << 25
MARK = "\x1e"


class _Memo:
    """Ids of known words, one after the other in an array."""

    def __init__(self):
        self.slots: dict[bytes, int] = {}
        self.bytes, self.used = 0, 0
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts, self.sizes = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, end = len(self.slots), len(self.slots) + len(words)
        self.ids = _room(self.ids, self.used, len(ids))
        self.starts, self.sizes = _room(self.starts, first, len(words)), _room(self.sizes, first, len(words))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[first:end] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:end] = sizes
        self.used += len(ids)
        self.bytes += sum(map(len, words))
        self.slots.update(zip(words, range(first, end)))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Slots of the words; -1: unknown."""
        return np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))

    def get(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in these slots, and how many each has."""
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[slots] - (ends - sizes), sizes) + np.arange(ends[-1])], sizes

    def full(self) -> bool:
        return len(self.slots) > MEMO_WORDS or self.bytes > MEMO_BYTES


def _room(a: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(a):
        return a
    out = np.empty(max(2 * len(a), used + more), a.dtype)
    out[:used] = a[:used]
    return out


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Ids of texts, word by word: ``encode(texts)`` gives all ids in one array and each text's number of ids.

    A word of lower-case Latin letters, with or without closing punctuation, is what the tokenizer's normaliser leaves
    alone and its splitter cuts into those two parts, so the merges alone give its ids. All other words go through the whole
    tokenizer, many in one call, told apart by a mark between them. Capital A-Z are lowered first, as the normaliser would, unless a mark that might combine with one follows it
    or a special token appears.
    """

    LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    MARKED = re.compile(rb"[A-Z][\xcc-\xf4]")
    PLAIN = re.compile("([a-z\xdf-\xf6\xf8-\xff]*)([!-/:-@\\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [t.encode() for t in special]
        self.hidden = [t for t in special if self.PLAIN.fullmatch(t)]  # a plain word may hold these
        mark = self._whole([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.letters = _byte_letters()
        self.closing: dict[str, list[int]] = {}
        self.memo, self.past = _Memo(), _Memo()

    def _lowered(self, text: bytes) -> bytes:
        low = text.translate(self.LOWER)
        return text if self.MARKED.search(text) or any(t in low for t in self.special) else low

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[list[int]]:
        """Ids of each word from one call, cut at a mark between the words that is an id of its own."""
        if not words or self.mark is None or any(MARK in w for w in words):
            return self._whole(words)
        flat = np.array(self._whole([f" {MARK} ".join(words) + f" {MARK}"])[0], np.uint32)
        cuts = np.flatnonzero(flat == self.mark).tolist()
        if len(cuts) != len(words):
            return self._whole(words)
        return [flat[a:b].tolist() for a, b in zip([0, *(c + 1 for c in cuts)], cuts)]

    def _close(self, mark: str) -> list[int]:
        if len(self.closing) > 10_000:
            self.closing.clear()
        self.closing[mark] = [t.id for t in self.tokenizer.model.tokenize(mark)] if mark else []
        return self.closing[mark]

    def _learn(self, words: list[bytes]) -> None:
        tokenize, letters, closing = self.tokenizer.model.tokenize, self.letters, self.closing
        plain, ids, sizes, rest = [], [], [], []
        for word, m in zip(words, map(self.PLAIN.fullmatch, b" ".join(words).decode().split(" "))):
            if m is None or self.hidden and any(t in m[0] for t in self.hidden):
                rest.append(word)
                continue
            core, mark = m.groups()
            if not core.isascii():
                core = core.encode().decode("latin-1").translate(letters)
            found = [t.id for t in tokenize(core)] if core else []
            found += closing[mark] if mark in closing else self._close(mark)
            plain.append(word)
            ids += found
            sizes.append(len(found))
        self.memo.add(plain, np.array(ids, np.uint32), np.array(sizes, np.int64))
        for i in range(0, len(rest), 1000):
            part = rest[i:i + 1000]
            found = self._joined([w.decode() for w in part])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.memo.add(part, np.fromiter(chain.from_iterable(found), np.uint32), sizes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.memo.full():
            self.memo, self.past = _Memo(), self.memo
        words, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(words)
            words += self._lowered(text).split()
            counts[i] = len(words) - before
        if not words:
            return np.empty(0, np.uint32), counts
        slots = self.memo.find(words)
        missing = np.flatnonzero(slots < 0).tolist()
        if missing:
            new = {words[i] for i in missing}
            again = [w for w in new if w in self.past.slots]
            if again:
                self.memo.add(again, *self.past.get(self.past.find(again)))
            self._learn(list(new.difference(again)))
            slots[missing] = self.memo.find([words[i] for i in missing])
        ids, sizes = self.memo.get(slots)
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(upto)


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Spans of texts of about CHUNK_BYTES together; a longer text is a span of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def cut_documents(docs: DataFrame, tokenizer: str, width: int = WIDTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and the ids themselves where asked for."""
    key = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<long>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in _chunks(texts):
                flat, sizes = encoder.encode(texts[a:b])
                owner, starts, lengths, crcs, totals, kept = [], [], [], [], [], []
                at = 0
                for i, n in enumerate(sizes.tolist()):
                    ids = np.append(flat[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for s in range(0, n + 1, width):
                        piece = ids[s:s + width]
                        owner.append(a + i)
                        starts.append(s)
                        lengths.append(len(piece))
                        crcs.append(zlib.crc32(piece.tobytes()))
                        totals.append(n + 1)
                        if with_ids:
                            kept.append(piece.astype(np.int64))
                cols = [batch.column(0).take(pa.array(owner, pa.int64()))]
                cols += [pa.array(c, pa.int64()) for c in (starts, lengths, crcs, totals)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(kept, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, out)


class CapacityTree:
    """Segment tree over remaining capacities 0..size-1: the least capacity >= c with an open window, and its windows."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves < size:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(size)]

    def put(self, capacity: int, first: int, n: int) -> None:
        self.ranges[capacity].append((first, n))
        self._add(capacity, n)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        first, n = self.ranges[capacity].pop()
        if n > most:
            self.ranges[capacity].append((first + most, n - most))
            n = most
        self._add(capacity, -n)
        return first, n

    def _add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.open[i] += n
            i //= 2

    def tightest(self, capacity: int) -> int | None:
        i = capacity + self.leaves
        if self.open[i]:
            return capacity
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def best_fit_runs(counts: dict[int, int], width: int = WIDTH) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counted lengths.

    Rows (length, first number, pieces a window, first window, offset): pieces of that length from that number on lie
    ``pieces a window`` each in consecutive windows, from ``offset`` there.
    """
    tree, runs, windows = CapacityTree(width + 1), [], 0
    for length in sorted(counts, reverse=True):
        number, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            each = (width if capacity is None else capacity) // length
            want = left // each or 1
            if capacity is None:
                capacity, first, n = width, windows, want
                windows += n
            else:
                first, n = tree.take(capacity, want)
            each = min(each, left)
            runs.append((length, number, each, first, width - capacity))
            tree.put(capacity - each * length, first, n)
            number += n * each
            left -= n * each
    return runs


def place(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces with a column ``length``."""
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(best_fit_runs(counts, width) or [(0, 0, 1, 0, 0)], np.int64)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    length, number, each, first, offset = runs[order].T
    key = (length << 48) + number

    @F.pandas_udf("sequence_id long, offset long")
    def at(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, rank = size.to_numpy(np.int64), rank.to_numpy(np.int64) - 1
        run = np.searchsorted(key, (size << 48) + rank, side="right") - 1
        i = rank - number[run]
        return pd.DataFrame({"sequence_id": first[run] + i // each[run], "offset": offset[run] + i % each[run] * size})

    tie = [F.col(c).asc_nulls_first() for c in ("doc_id", "start", "ids_crc32", "_tie")]
    ranked = exact_row_number(pieces.withColumn("_tie", F.monotonically_increasing_id()), ["length"], tie, "_rank")
    placed = ranked.withColumn("_at", at("length", "_rank"))
    return placed.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their window (``sequence_id``) and place in it (``offset``)."""
    return place(staged(cut_documents(docs, tokenizer, width, end_id, with_ids), "pieces"), width)
