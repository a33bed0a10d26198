"""Ordered folds: one pass over each key's rows in order, with state carried from batch to batch.

A key is folded in one task, as its order demands, but streams through it: what is held is a batch
and the kernel's state, however long the key. Keys, symbols or parameter sets, run side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class Kernel(Protocol):
    def push(self, rows: pd.DataFrame) -> pd.DataFrame | None:
        """Rows of one key, in order, after those pushed before; returns finished output."""

    def close(self) -> pd.DataFrame | None:
        """What is left when the key ends."""


def ordered_fold(rows: DataFrame, keys: list[str], order: list[str], kernel: Callable[[tuple], Kernel], schema: str) -> DataFrame:
    """``kernel(key values)`` folded over each key; output frames have the columns of ``schema``."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, own = None, None
        for frame in frames:
            if frame.empty:
                continue
            change = np.flatnonzero((frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()[1:]) + 1
            for a, b in zip([0, *change], [*change, len(frame)], strict=True):
                part = frame.iloc[a:b]
                key = tuple(part[k].iloc[0] for k in keys)
                if key != now:
                    if own is not None and (out := own.close()) is not None and len(out):
                        yield out[names]
                    now, own = key, kernel(key)
                if (out := own.push(part)) is not None and len(out):
                    yield out[names]
        if own is not None and (out := own.close()) is not None and len(out):
            yield out[names]

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
