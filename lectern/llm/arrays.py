"""Fixed-size count arrays gathered over all rows, and hashes of words.

A model that is an array of fixed size is counted by every task over all its rows, cut into blocks and merged block by
block after one shuffle; what reaches the driver has the size of the arrays, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

BLOCK = 1024      # array cells per shuffled row
REMEMBERED = 400_000  # words a worker remembers before it starts anew

MERGE = {"add": np.add, "or": np.bitwise_or}


class WordHashes(dict):
    """64-bit hash of a word given as bytes, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = self.hashed(word)
        return value

    @staticmethod
    def hashed(word: bytes) -> int:
        return xxhash.xxh64_intdigest(word)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def gathered(df: DataFrame, count: Callable[[Iterable[pd.DataFrame]], dict[str, np.ndarray]],
             spec: dict[str, tuple[int, str]]) -> dict[str, np.ndarray]:
    """``count`` makes each task's int64 arrays; ``spec`` gives each array's size and merge (add or or)."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, array in count(batches).items():
            cells = array.astype(np.int64, copy=False).reshape(-1, BLOCK)
            full = np.flatnonzero(cells.any(axis=1))
            for part in np.array_split(full, max(1, len(full) // 256)):
                if len(part):
                    yield pd.DataFrame({"name": name, "block": part.astype(np.int32),
                                        "cells": [cells[i].tobytes() for i in part]})

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for name, block, cells in zip(batch["name"], batch["block"], batch["cells"]):
                new = np.frombuffer(cells, np.int64)
                old = held.get((name, block))
                held[name, block] = new if old is None else MERGE[spec[name][1]](old, new)
        if held:
            yield pd.DataFrame({"name": [k[0] for k in held], "block": np.array([k[1] for k in held], np.int32),
                                "cells": [v.tobytes() for v in held.values()]})

    schema = "name string, block int, cells binary"
    rows = df.mapInPandas(blocks, schema).repartition("name", "block").mapInPandas(merged, schema)
    out = {name: np.zeros(size, np.int64) for name, (size, _) in spec.items()}
    for r in rows.collect():  # at most sum(size) / BLOCK rows
        out[r["name"]].reshape(-1, BLOCK)[r["block"]] = np.frombuffer(r["cells"], np.int64)
    return out


def document_runs(counts: np.ndarray, most: int = 200_000) -> Iterator[slice]:
    """Consecutive documents with about ``most`` words together; a longer document comes alone."""
    start, held = 0, 0
    for i, n in enumerate(counts):
        if i > start and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(counts):
        yield slice(start, len(counts))
