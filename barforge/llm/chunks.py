"""Tables of chunks of text that were seen before, looked up and gathered a slice of Arrow texts at a time.

A tokenizer says where chunks start in the UTF-8 of some texts and what the values (ids, a count) of
new chunks are. Chunks are views of the Arrow buffer; a hash lookup of all of them at once gives
their numbers, by which values are gathered from one flat array. A full table keeps the half that
was used most; that costs time, never values.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that are looked up at once.
AT_ONCE = 1_000_000


class Ragged:
    """Arrays in one flat array, gathered by number."""

    def __init__(self, kind):
        self.kind = kind
        self.flat, self.first, self.size = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.first = np.r_[self.first, len(self.flat) + np.cumsum(size) - size]
        self.flat, self.size = np.r_[self.flat, flat].astype(self.kind, copy=False), np.r_[self.size, size]

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[numbers]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.first[numbers] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], size

    def keep(self, numbers: np.ndarray) -> None:
        flat, size = self.take(numbers)
        self.__init__(self.kind)
        self.add(flat, size)


class Known:
    """Values of at most some ``most`` chunks; ``learn`` gives new chunks in an order of its own, their values and sizes."""

    def __init__(self, learn: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]], most: int, kind):
        self.learn, self.most = learn, most
        self.chunks, self.values, self.used = pa.array([], pa.large_string()), Ragged(kind), np.empty(0, np.int64)

    def add(self, chunks: pa.Array, flat: np.ndarray, size: np.ndarray, used: np.ndarray | int = 0) -> None:
        self.chunks = pa.concat_arrays([self.chunks, chunks.cast(pa.large_string())])
        self.values.add(flat, size)
        self.used = np.r_[self.used, np.broadcast_to(used, len(chunks))]

    def _forget(self) -> None:
        best = np.sort(np.argpartition(-self.used, self.most // 2)[: self.most // 2])
        self.chunks, self.used = self.chunks.take(pa.array(best)), self.used[best] // 2
        self.values.keep(best)

    def take(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Values of all chunks in a row, and how many each has."""
        if len(self.chunks) > self.most:
            self._forget()
        base = len(self.chunks)
        number = pc.index_in(chunks, value_set=self.chunks).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            missing = chunks.take(pa.array(new))
            order, flat, size = self.learn(missing.unique().to_pylist())
            fresh = pa.array(order, pa.large_string())
            self.add(fresh, flat, size)
            number[new] = base + pc.index_in(missing, value_set=fresh).to_numpy()
        self.used += np.bincount(number, minlength=len(self.used))
        return self.values.take(number)


def views(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The chunks that start at ``starts``, the last of which ends with ``data``."""
    first = int(starts[0]) if len(starts) else len(data)
    bounds = np.append(starts, len(data)) - first
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[first:])])


def gathered(known: Known, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all chunks in a row, and where those of each text start (and the last one's end)."""
    bounds = np.append(starts, len(data))
    flat, sizes = [np.empty(0, known.values.kind)], [np.zeros(1, np.int64)]
    for at in range(0, len(starts), AT_ONCE):
        values, size = known.take(views(data[: bounds[min(at + AT_ONCE, len(starts))]], starts[at : at + AT_ONCE]))
        flat.append(values), sizes.append(size)
    ends = np.cumsum(np.concatenate(sizes))
    return np.concatenate(flat), ends[np.searchsorted(starts, offsets)]
