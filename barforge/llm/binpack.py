"""Best-fit packing of documents into sequences, by vectors of capacities.

A sequence has three residual capacities: tokens, documents and attention cost (the sum of squared
lengths). All an item asks for follows from its length, so the plan is made on the histogram of
lengths: sequences with equal residuals and contents are one *state* with a count, and items of a
length are placed, longest first, into the feasible state with the least weighted residual norm
(or the greatest weighted dot product of demand and residual), as many at once as the state has
sequences. Every step uses up a state or a length, so states number at most a few per length and
the driver's work depends on the capacity alone, not on the corpus.

Items then find their place by their rank among the items of their length: counted within each
partition of a written table, plus the counts of the partitions before. No length, however
frequent, meets in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm import bytebpe, scratch
from barforge.llm.sources import TOKENIZER_BYTES, id_text, slices


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds; by default documents and attention cost follow from the tokens."""

    tokens: int = 1024
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.0625, 0.25)
    rule: str = "norm"  # or "dot"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.cost or self.tokens**2], np.int64)


def demand(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], np.int64)


def plan(histogram: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place every item once.

    Item ``r`` of a length goes to sequence ``first sequence + r - first rank`` of its run.
    """
    full, weights = capacity.vector(), np.array(capacity.weights)
    rooms = np.zeros((256, 3), np.int64)  # residuals of the open states, in arrays that double
    counts = np.zeros(256, np.int64)
    inside: list[tuple[tuple[int, int], ...]] = []  # (length, items) in order of placing

    def opened(residual: np.ndarray, sequences: int, parts: tuple[tuple[int, int], ...]) -> int:
        nonlocal rooms, counts
        at = len(inside)
        if at == len(counts):
            rooms, counts = np.concatenate([rooms, np.zeros_like(rooms)]), np.concatenate([counts, np.zeros_like(counts)])
        rooms[at], counts[at] = residual, sequences
        inside.append(parts)
        return at

    for length in sorted(histogram, reverse=True):
        left, need = int(histogram[length]), demand(length)
        if (need > full).any() or length < 0:
            raise ValueError(f"an item of {length} tokens fits no sequence")
        while left:
            room, count = rooms[: len(inside)], counts[: len(inside)]
            fits = np.flatnonzero((room >= need).all(axis=1) & (count > 0))
            if len(fits):
                rest = (room[fits] - need) / full
                score = (weights * rest**2).sum(axis=1) if capacity.rule == "norm" else -(weights * (room[fits] / full) * (need / full)).sum(axis=1)
                at = int(fits[np.argmin(score)])
                each = int(min(np.where(need > 0, room[at] // np.maximum(need, 1), left).min(), -(-left // count[at])))
            else:  # new sequences, each filled with this length as far as it goes
                each = min(int(np.where(need > 0, full // np.maximum(need, 1), left).min()), left)
                at = opened(full, -(-left // each), ())
            moved = min(left // each, int(counts[at]))
            opened(rooms[at] - each * need, moved, (*inside[at], (length, each)))
            counts[at] -= moved
            left -= moved * each
            if counts[at] and not len(inside[at]) and not left:
                counts[at] = 0  # opened for a remainder that is placed by now
        if len(inside) > 4096:
            kept = np.flatnonzero(counts[: len(inside)])
            rooms[: len(kept)], counts[: len(kept)], inside[:] = rooms[kept], counts[kept], [inside[i] for i in kept]
            counts[len(kept) :] = 0
    runs, rank, sequence = [], Counter(), 0
    for n, parts in zip(counts[: len(inside)].tolist(), inside, strict=True):
        if n and parts:
            offset = 0
            for length, each in parts:
                for _ in range(each):
                    runs.append((length, rank[length], n, sequence, offset))
                    rank[length] += n
                    offset += length
            sequence += n
    if dict(rank) != {k: v for k, v in histogram.items() if v}:
        raise AssertionError("the plan does not place every item once")
    return runs


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, at_once: int = TOKENIZER_BYTES, chunks: int = bytebpe.CHUNKS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every whole text.

    A document's ids end with ``end_id``. Only documents over ``tokens`` ids are cut, from the end
    on, so the first piece may be shorter. A null text counts as empty and gives one piece. Repeated
    rows give pieces of their own, an empty table none; other columns are not looked at. Bytes of text
    ``at_once`` and the ``chunks`` of a worker's table set its memory and time, not the rows.
    """
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bytebpe.encoder(tokenizer, chunks)
        for batch in slices(batches, most=at_once, rows=65_536):
            flat, ends = own.encode_array(batch.column("text"))
            flat = np.insert(flat, ends[1:], end_id).astype("<u4", copy=False)
            first = ends + np.arange(len(ends))  # of each document's ids, its end included
            size = np.diff(first)
            per = np.maximum(1, -(-size // tokens))
            at = np.repeat(np.arange(len(size)), per)
            piece = np.arange(len(at)) - np.repeat(np.cumsum(per) - per, per)
            lead = size - (per - 1) * tokens  # what the first piece has
            start = np.where(piece > 0, lead[at] + (piece - 1) * tokens, 0)
            length = np.where(piece > 0, tokens, lead[at])
            begin = (first[at] + start).tolist()
            crc = [zlib.crc32(flat[a : a + n]) for a, n in zip(begin, length.tolist(), strict=True)]
            columns = [batch.column("doc_id").take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)).astype(np.int32)), pa.array(flat.astype(np.int32)))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def pack(items: DataFrame, capacity: Capacity = Capacity(), length_col: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (long) to items with a length of 0 or more tokens.

    Sequences are numbered from 0 and filled without gaps from offset 0. Null lengths count as 0.
    Repeated rows are items of their own. Raises for an item that is over the capacity by itself.
    Items are written before they are numbered: Python that makes them and Python that numbers them
    would else be two workers of one task.
    """
    spark = items.sparkSession
    length, shard, slot, base = "__length", "__shard", "__slot", "__base"
    schema = items.withColumns({length: F.lit(0).cast("long"), shard: F.lit(0), slot: F.lit(0).cast("long")}).schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            lengths = [x or 0 for x in batch.column(length_col).to_pylist()]
            ranks = []
            for x in lengths:
                ranks.append(seen[x])
                seen[x] += 1
            more = [pa.array(lengths, pa.int64()), pa.array([own] * len(lengths), pa.int32()), pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, length, shard, slot])

    with scratch.passing(spark) as table:
        numbered = scratch.table(table(items, "pack-made").mapInArrow(number, schema), "pack-items")
    counts = numbered.groupBy(shard, length).agg((F.max(slot) + 1).alias("__n"))
    histogram = {r[0]: r[1] for r in counts.groupBy(length).agg(F.sum("__n")).collect()}  # one row per length, so at most the capacity
    runs = plan(histogram, capacity)
    ordered = np.array(sorted(runs), np.int64).reshape(-1, 5)
    by_length = {int(x): ordered[ordered[:, 0] == x, 1:] for x in histogram}
    before = Window.partitionBy(length).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(shard, length, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(base))
    placed = numbered.join(bases, [shard, length]).select(*[F.col(f"`{c}`") for c in items.columns], length, (F.col(slot) + F.col(base)).alias(slot))
    out_schema = items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    clash = {"sequence_id", "offset"}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(length).to_numpy(), batch.column(slot).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for x in np.unique(lengths).tolist():
                own, of = by_length[x], np.flatnonzero(lengths == x)
                at = np.searchsorted(own[:, 0], ranks[of], side="right") - 1
                sequence[of] = own[at, 2] + ranks[of] - own[at, 0]
                offset[of] = own[at, 3]
            made = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([made.get(f.name, batch.column(f.name) if f.name not in clash else None) for f in out_schema.fields], out_schema.names)

    return placed.mapInArrow(place, out_schema)
