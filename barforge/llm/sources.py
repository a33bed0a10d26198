"""Reading the corpus tables, and Arrow helpers that the Python stages share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python stages hold at most this much text at a time, or one document where that is longer.
SLICE_BYTES = 1 << 19
#: Tokenizers look a slice's chunks up at once; their arrays take a few bytes for each byte of text.
TOKENIZER_BYTES = 4 << 20
#: A slice has so many rows at most, whatever their length.
SLICE_ROWS = 2048

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and whole text; a null text counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about ``most`` bytes of ``column`` and at most ``rows`` rows."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and (held + n > most or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)
        del batch
        _give_back()


def _give_back() -> None:
    """Memory that the allocators hold for later: a worker that waits should not keep it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
