"""Fixed-size hashed counts over whole tables.

The histogram has ``2**bits`` cells whatever the data's size, so it may be
collected and broadcast.  Every task counts its rows, cells are summed in
slices, and only the sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICES = 16


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_counts(df: DataFrame, hashes: Callable[[list[str]], np.ndarray], bits: int = 18) -> np.ndarray:
    """How often each cell of the upper ``bits`` bits of ``hashes(texts)`` occurs in the only column of ``df``."""
    shift = np.uint64(64 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            h = hashes([x for x in b.column(0).to_pylist() if x])
            if len(h):
                total += np.bincount((h >> shift).astype(np.int64), minlength=1 << bits)
        if total.any():
            parts = np.split(total, SLICES)
            yield pa.RecordBatch.from_pydict({"slice": np.arange(SLICES, dtype=np.int32), "cells": [p.tobytes() for p in parts]})

    def add(key, pdf):
        import pandas as pd

        total = sum(np.frombuffer(c, np.int64) for c in pdf["cells"])
        return pd.DataFrame({"slice": [key[0]], "cells": [total.tobytes()]})

    parts = df.mapInArrow(count, "slice int, cells binary").groupBy("slice").applyInPandas(add, "slice int, cells binary").collect()
    out = np.zeros(1 << bits, np.int64).reshape(SLICES, -1)
    for r in parts:
        out[r["slice"]] = np.frombuffer(r["cells"], np.int64)
    return np.minimum(out.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)
