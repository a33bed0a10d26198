"""Token ids in fixed-width bit packing, one self-contained block per row.

Format (a Parquet table, so any store that Spark writes to will do). A row is a block:

=========  ===============  =====================================================================
shard      int              file order; shards follow one another in ascending id order
first      long             ids of the shard before this block: the block's offset
width      int              bits an id takes, the fewest that hold ``vocabulary - 1``
payload    binary           ids, little-endian bit order, ``width`` bits each, padded to a byte
low, high  id type          the least and the greatest id of the block's documents
doc_ids    array<id type>   the block's documents in ascending order
lengths    array<int>       ids of each document
=========  ===============  =====================================================================

A block closes at the first document end after ``BLOCK_IDS`` ids, so a document never spans two
and any of them can be read by itself: document ``k`` takes bits ``width * sum(lengths[:k])`` on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import bytebpe, scratch
from barforge.llm.sources import TOKENIZER_BYTES, id_text, slices

BLOCK_IDS = 65_536


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each; raises where one does not fit."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id does not fit into {width} bits")
    if width == 16:
        return ids.astype("<u2").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits, axis=None, bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from the ``start``-th on, without touching what lies before them."""
    if width == 16:
        return np.frombuffer(payload, "<u2", count, 2 * start).astype(np.uint32)
    first, last = start * width // 8, -(-(start + count) * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first), bitorder="little")
    lead = start * width - first * 8
    out = np.zeros((count, 32), np.uint8)
    out[:, :width] = bits[lead : lead + count * width].reshape(count, width)
    return np.packbits(out, axis=1, bitorder="little").view("<u4").ravel()


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, append ``end_id``, and write blocks in ascending id order to ``path``.

    A null text counts as empty. Rows with null ids come first, rows with one id follow one another
    in the order of their texts. An empty table gives a table without blocks.
    """
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = bytebpe.encoder(tokenizer), TaskContext.get().partitionId()
        width = bits_for(max(own.size, (end_id or 0) + 1))
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        first, held, keys, lengths = 0, [], [], []

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            keys_of = pa.concat_arrays(keys)
            values = [pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([width], pa.int32()), pa.array([pack(ids, width)], pa.binary()), *(pa.array([x], keys_of.type) for x in (pc.min(keys_of), pc.max(keys_of))), pa.ListArray.from_arrays(pa.array([0, len(keys_of)], pa.int32()), keys_of), pa.array([lengths], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(values, ["shard", "first", "width", "payload", "low", "high", "doc_ids", "lengths"])

        size = 0
        for batch in slices(batches, most=TOKENIZER_BYTES, rows=65_536):
            flat, ends = own.encode_array(batch.column("text"))
            if len(tail):
                flat, ends = np.insert(flat, ends[1:], tail[0]), ends + np.arange(len(ends))
            done = 0  # documents of this slice that are in a block
            while done < batch.num_rows:
                upto = min(batch.num_rows, done + 1 + int(np.searchsorted(ends[done + 1 :], ends[done] + BLOCK_IDS - size)))
                held.append(flat[ends[done] : ends[upto]])
                keys.append(batch.column("doc_id").slice(done, upto - done))
                lengths += np.diff(ends[done : upto + 1]).tolist()
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    first, size, held, keys, lengths = first + size, 0, [], [], []
                done = upto
        if keys:
            yield block()

    ordered = rows.repartitionByRange(scratch.partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, f"shard int, first long, width int, payload binary, low {kind}, high {kind}, doc_ids array<{kind}>, lengths array<int>").write.parquet(path)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the blocks at ``path``; nothing from an empty table.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the unsigned crc32 of the
    document's ids as little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.parquet(path)
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    # one row per file of the table, so as many as partitions wrote it
    totals = blocks.select("shard", size.alias("n")).groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()
    ends = np.cumsum([0, *[r.n for r in totals]])
    base = {r.shard: int(b) for r, b in zip(totals, ends, strict=False)}
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, first, width, payload = (batch.column(c)[i].as_py() for c in ("shard", "first", "width", "payload"))
                lengths = batch.column("lengths")[i].values.to_numpy()
                ends = np.cumsum(lengths, dtype=np.int64)
                ids = unpack(payload, width, 0, int(ends[-1])).astype("<u4")
                starts = ends - lengths
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values, pa.array(base[shard] + first + starts), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, path: str, doc_id) -> list[np.ndarray]:
    """Random access: the ids of the documents with this id, unpacked from their blocks alone.

    Blocks are found by their least and greatest id, which the store can skip row groups by. Without
    such a document the list is empty; documents that share an id come one by one.
    """
    found = spark.read.parquet(path).where((F.col("low") <= F.lit(doc_id)) & (F.col("high") >= F.lit(doc_id)) & F.array_contains("doc_ids", doc_id))
    out = []
    for row in found.collect():
        ends = np.cumsum(row.lengths)
        out += [unpack(row.payload, row.width, int(e) - n, n) for d, n, e in zip(row.doc_ids, row.lengths, ends, strict=True) if d == doc_id]
    return out
