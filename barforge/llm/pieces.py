"""SentencePiece encoding and decoding by a table of distinct chunks.

A chunk is a run of white-space markers and the characters up to the next marker. Where no piece
of the vocabulary holds a marker behind another character, no merge can cross the boundary of two
chunks, so a text's ids are the ids of its chunks in order.

Distinct chunks are counted over the whole corpus; the ``FREQUENT`` most frequent ones are segmented
once, with the sentencepiece library, and their table is broadcast. A task segments other chunks
when it first meets them, keeps them in a bounded table, and joins all ids back by position. (A
table of all chunks would have to be joined to every position of every text, a shuffle several
times as large as the input.) What is in which table changes time, never ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.chunks import Known, gathered, views
from barforge.llm.shingles import buffers
from barforge.llm.sources import TOKENIZER_BYTES, id_text, slices

MARK = "▁"
#: Chunks that a worker's table holds at most, and those of the corpus that are shared with all.
CHUNKS, FREQUENT = 400_000, 100_000
#: Counted chunks that a task holds before it adds equal ones up.
COUNTED = 1_000_000
_models: dict[str, "ChunkTable"] = {}


def marked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 of texts with spaces for markers and one in front, where each text starts, and each chunk.

    The space in front is the library's dummy prefix; an empty text has none.
    """
    texts = pc.replace_substring(texts.cast(pa.large_string()), MARK, " ")
    one = lambda s: pa.scalar(s, pa.large_string())
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(one(""), texts, one(" ")))
    data, offsets = buffers(texts)
    space = data == 0x20
    starts = space.copy()
    starts[1:] &= ~space[:-1]
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    return data, offsets, np.flatnonzero(starts)


class ChunkTable:
    """Ids of chunks for one model file; rejects models whose pieces or normaliser break the method."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross white-space markers; the chunk table does not apply")
        probe = " a  b\tﬁ　 "
        if self.model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("this model rewrites characters or white space; the chunk table does not apply")
        self.lone = [self.model.piece_to_id(MARK)]
        self.known = Known(self.segment, CHUNKS, np.int32)
        self.shared = ""

    def segment(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Ids of chunks, each of which starts with the space that the library's prefix rule puts there itself."""
        ids = []
        for at in range(0, len(chunks), 4096):
            part = [c[1:] for c in chunks[at : at + 4096]]
            # nothing is left of a lone marker, which the prefix rule leaves out
            ids += [x if c else self.lone for c, x in zip(part, self.model.encode(part, num_threads=1), strict=True)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return chunks, np.fromiter((i for x in ids for i in x), np.int32, int(size.sum())), size

    def share(self, name: str, table: pa.Table) -> None:
        """Start with a corpus table (chunk, n, ids) of this name, unless this worker has it."""
        if self.shared != name:
            self.shared, self.known = name, Known(self.segment, CHUNKS, np.int32)
            ids = table.column("ids").combine_chunks()
            self.known.add(table.column("chunk").combine_chunks(), ids.flatten().to_numpy(), pc.list_value_length(ids).to_numpy().astype(np.int64), table.column("n").to_numpy())

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """int32 ids of all texts in a row, and where each text's start (and the last one's end)."""
        return gathered(self.known, *marked(texts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, ends = self.encode_array(pa.array(texts, pa.large_string()))
        return np.split(flat, ends[1:-1]) if texts else []


def chunk_table(path: str) -> ChunkTable:
    if path not in _models:
        _models[path] = ChunkTable(path)
    return _models[path]


def counted(rows: DataFrame) -> DataFrame:
    """``chunk, n`` of the corpus' chunks; those that a task meets just once are left to the tasks that encode."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("chunk", use_threads=False).aggregate([("n", "sum")]).rename_columns(["chunk", "n"])

        for batch in slices(batches, most=TOKENIZER_BYTES, rows=65_536):
            data, _, starts = marked(batch.column("text"))
            seen = views(data, starts).value_counts()
            held.append(pa.table({"chunk": seen.field("values"), "n": seen.field("counts")}))
            if sum(t.num_rows for t in held) > COUNTED:
                held = [summed()]
        if held:
            whole = summed()
            whole = whole.filter(pc.greater(whole.column("n"), 1))
            yield from pa.table({"chunk": whole.column("chunk").cast(pa.string()), "n": whole.column("n").cast(pa.int64())}).to_batches(max_chunksize=65_536)

    return rows.select("text").mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def corpus_table(rows: DataFrame, model: str, most: int = FREQUENT) -> pa.Table:
    """``chunk, n, ids`` of the ``most`` most frequent chunks, each segmented once; at most so many rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in batches:
            _, flat, size = table.segment(batch.column("chunk").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], ["chunk", "n", "ids"])

    best = counted(rows).orderBy(F.desc("n"), "chunk").limit(most)
    return best.mapInArrow(run, "chunk string, n long, ids array<int>").toArrow()


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id`` and ``ids``: the whole text's ids, as the library's ``encode`` gives them.

    With ``decoded`` also the library's text of these ids. A null or empty text has no ids.
    Repeated rows and ids are kept row by row, an empty table gives an empty result; other columns,
    whatever their names, are not looked at.
    """
    rows = id_text(docs, id_col, text_col)
    sent, name = docs.sparkSession.sparkContext.broadcast(corpus_table(rows, model, frequent)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        table.share(name, sent.value)
        for batch in slices(batches, most=TOKENIZER_BYTES, rows=65_536):
            flat, ends = table.encode_array(batch.column("text"))
            columns, names = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], ["doc_id", "ids"]
            if decoded:
                bounds = ends.tolist()
                texts = [table.model.decode(flat[a:b].tolist()) if b > a else "" for a, b in zip(bounds, bounds[1:], strict=False)]
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded``, the library's text of ``ids``; null and empty ids decode to an empty text.

    Repeated rows and other columns stay as they are; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = chunk_table(model).model
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [library.decode(x) if x else "" for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    from pyspark.sql import types as T

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
