"""Packing against the tokenizers library and against best-fit decreasing run piece by piece."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm import packing
from lectern.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_fill(lengths, width):
    """Fill of each window after placing pieces one by one, longest first, in the tightest window."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(width - n)
    return sorted(width - r for r in room)


@pytest.mark.parametrize("width", [1, 7, 64, 100])
def test_runs_equal_piecewise_best_fit(width):
    rng = random.Random(width)
    for _ in range(60):
        lengths = [rng.randrange(1, width + 1) if rng.random() < 0.8 else min(3, width) for _ in range(rng.randrange(60))]
        counts = Counter(lengths)
        runs = packing.best_fit_runs(counts, width)
        fill, placed = {}, Counter()
        runs.append((0, 0, 1, 0, 0))
        for (length, number, each, first, offset), after in zip(runs, runs[1:]):
            until = after[1] if after[0] == length else counts[length]
            for i in range(until - number):
                window, at = first + i // each, offset + i % each * length
                assert fill.get(window, 0) == at  # gapless, no overlap
                fill[window] = at + length
                placed[length] += 1
        assert placed == counts and sorted(fill.values()) == brute_fill(lengths, width)
        assert sorted(fill) == list(range(len(fill)))


def check(docs, rows, width):
    tokenizer = Tokenizer.from_file(PATH)
    windows, pieces = {}, {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= width
    assert sorted(sum(n for _, n in s) for s in windows.values()) == brute_fill([r.length for r in rows], width)
    for doc_id, text in docs.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        got = sorted(pieces.pop(doc_id), key=lambda r: r.start)
        assert [r.start for r in got] == list(range(0, len(ids), width))
        for r in got:
            part = ids[r.start:r.start + width]
            assert (r.length, r.doc_tokens, r.ids_crc32) == (len(part), len(ids), zlib.crc32(part.tobytes()))
    assert not pieces


def test_query_on_given_table(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    check(docs, QUERIES["op12_best_fit_packing"](spark, sf_small).collect(), packing.WIDTH)


def test_odd_texts(spark, monkeypatch):
    rng = random.Random(0)
    odd = [None, "", " \n\t ", "a", "It's we'll THEY'RE 12345 x\x1ey \x1e", "ΣΑΣ ΌΣΟΣ Σ ς", "é ́x Å 가",
           "日本語のテキスト。" * 50, "x" * 5000, "\x85\x1c  z", "😀😀 ok\x00nul", "İ İ ﬁ"]
    alphabet = "tdJßab'S \ń é1,.\x1eΣ日"
    odd += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(200)]
    monkeypatch.setattr(packing, "CHUNK_BYTES", 300)
    docs = dict(enumerate(odd))
    df = spark.createDataFrame([(i, t, i, "x") for i, t in docs.items()], "doc_id long, text string, length long, _rank string")
    check(docs, packing.pack(df, PATH, width=64).collect(), 64)


def test_memo_emptied_between_chunks(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_WORDS", 3)
    encoder, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    for text in ["one two three four", "five", "one two", "", "six one"]:
        ids, sizes = encoder.encode([text.encode(), b"", text.encode()])
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and sizes.tolist() == [len(want), 0, len(want)]


def test_ids_null_keys_and_repeats(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three"), (None, None)], "doc_id long, text string")
    rows = packing.pack(df, PATH, with_ids=True).collect()
    assert sorted(((r.doc_id is None, r.length, tuple(r.ids)[-1]) for r in rows)) == [(False, 3, 1), (False, 3, 1), (True, 1, 1), (True, 2, 1)]
    assert {r.sequence_id for r in rows} == {0} and sorted(r.offset for r in rows) == [0, 3, 6, 8]
