"""Document fingerprints of improbable features in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy level. Levels are ranked by how rare they are over
the whole corpus, counted in one aggregation, so that the rarest level comes first; windows under
``LEAST_LEVEL`` (runs, padding) never count. In each run of ``RUN`` windows the leftmost of the
best rank is favoured, and windows favoured ``FAVOURED`` times or more are the text's features. A
text without such a window has its best window and ``SPREAD`` more, at even distances, as features;
one shorter than a window is its own feature.
Features, in order of place, set ``HASHES`` bits each in a chain of Bloom filters of ``BITS`` bits,
``PER_FILTER`` features to a filter. The fingerprint is the chain in base64, "" for an empty text.

Likeness matches each filter of the shorter chain with the filter of the other chain that overlaps
it best. An overlap counts from what two unrelated filters share by chance (0) to the most that
the smaller one can share (1).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm import scratch
from barforge.llm.shingles import _BASE, SEGMENT, buffers, mix
from barforge.llm.sources import id_text, slices

WINDOW = 16
RUN = 16
FAVOURED = 5
LEVELS = 256
LEAST_LEVEL = 64
BITS = 2048
HASHES = 5
PER_FILTER = 128
#: Share of the way from chance to full overlap that unrelated filters may reach.
CHANCE = 0.1
#: Windows that a text without features is known by, besides its best one.
SPREAD = 16
SLICE = 1 << 20

_SCALE = 1 << 20
_TERM = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], np.int64)
_FULL = int(_TERM[WINDOW])
_BYTE = np.random.default_rng(40407).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORST = np.int64(1 << 20)


def levels(data: np.ndarray) -> np.ndarray:
    """The entropy level of each window of a buffer, by what a byte's leaving and entering change."""
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int64)
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)  # times that a byte is in the window it starts, ends
    for s in range(1, WINDOW):
        same = (data[:-s] == data[s:]).view(np.uint8)
        ahead[:-s] += same
        behind[s:] += same
    first = int(_TERM[np.bincount(data[:WINDOW], minlength=256)].sum())
    step = np.diff(_TERM, prepend=0)  # what the c-th of a byte adds
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = first
    np.cumsum(step[behind[WINDOW:]] - step[ahead[: n - WINDOW]], out=total[1:])
    total[1:] += first
    return (_FULL - total) * (LEVELS - 1) // _FULL


def _ends(offsets: np.ndarray, first: int, n: int) -> np.ndarray:
    """Where the text of each of ``n`` bytes from ``first`` on ends."""
    return offsets[np.searchsorted(offsets, np.arange(first, first + n), side="right")]


def histogram(rows: DataFrame) -> np.ndarray:
    """Windows of each entropy level over all texts; null and empty texts have none, repeated rows count again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(LEVELS, np.int64)
        for batch in slices(batches, most=SLICE):
            data, offsets = buffers(batch.column("text").fill_null(""))
            for low in range(0, len(data), SEGMENT):
                found = levels(data[low : low + SEGMENT + WINDOW - 1])
                whole = np.arange(low, low + len(found)) + WINDOW <= _ends(offsets, low, len(found))
                seen += np.bincount(found[whole], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS), pa.int32()), pa.array(seen)], ["level", "n"])

    out = np.zeros(LEVELS, np.int64)
    for r in rows.select("text").mapInArrow(run, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():  # LEVELS rows
        out[r.level] = r.n
    return out


@dataclass(frozen=True)
class Ranks:
    """Rank of each level: 0 for the rarest that occurs."""

    of_level: np.ndarray

    @classmethod
    def by_rarity(cls, counts: np.ndarray) -> "Ranks":
        order = np.lexsort((np.arange(LEVELS), np.where(counts > 0, counts, np.iinfo(np.int64).max)))
        ranks = np.empty(LEVELS, np.int64)
        ranks[order] = np.arange(LEVELS)
        ranks[:LEAST_LEVEL] = _WORST
        return cls(ranks)


def _ranked(data: np.ndarray, offsets: np.ndarray, ranks: Ranks, first: int, last: int) -> np.ndarray:
    """Ranks of the windows from ``first`` to ``last``; those that leave their text come after all others."""
    found = levels(data[first : last + WINDOW - 1])
    return np.where(np.arange(first, first + len(found)) + WINDOW <= _ends(offsets, first, len(found)), ranks.of_level[found], 2 * _WORST)


def _features(data: np.ndarray, offsets: np.ndarray, ranks: Ranks) -> np.ndarray:
    """Places of the windows that are favoured often enough, a segment at a time."""
    n, out = len(data), [np.empty(0, np.int64)]
    for low in range(0, n, SEGMENT):
        high = min(n, low + SEGMENT)
        first = max(0, low - RUN + 1)  # a run that holds a window of the segment starts here or later
        rank = _ranked(data, offsets, ranks, first, min(n, high + RUN - 1))
        best = (rank << 40) | np.arange(len(rank))
        width = 1
        while width < RUN and len(best) > width:  # least key of each run, doubling
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width == RUN:
            inside = np.arange(first, first + len(best)) + WINDOW + RUN - 1 <= _ends(offsets, first, len(best))
            favoured = np.bincount(best[inside] & ((1 << 40) - 1), minlength=len(rank))
            places = first + np.flatnonzero((favoured >= FAVOURED) & (rank < _WORST))
            out.append(places[(places >= low) & (places < high)])
    return np.concatenate(out)


def _plain_features(data: np.ndarray, offsets: np.ndarray, ranks: Ranks, a: int, b: int) -> list[int]:
    """Places in a text without features: its leftmost window of the best rank, and windows spread over it."""
    least, at = None, a
    for low in range(a, b - WINDOW + 1, SEGMENT):
        rank = _ranked(data, offsets, ranks, low, min(b - WINDOW + 1, low + SEGMENT))
        if least is None or rank.min() < least:
            least, at = rank.min(), low + int(rank.argmin())
    return sorted({at, *(a + k * (b - a - WINDOW) // SPREAD for k in range(SPREAD + 1))})


def filters(texts: pa.Array, ranks: Ranks) -> list[np.ndarray]:
    """The chain of each text: a row of ``BITS // 8`` bytes for each filter; none for an empty text."""
    data, offsets = buffers(texts)
    count = len(offsets) - 1
    feature = _features(data, offsets, ranks)
    owner = np.searchsorted(offsets, feature, side="right") - 1
    with_one = np.bincount(owner, minlength=count) > 0
    owners, places, sizes = [owner], [feature], [np.full(len(feature), WINDOW)]
    for i in np.flatnonzero(~with_one & (np.diff(offsets) > 0)).tolist():
        a, b = int(offsets[i]), int(offsets[i + 1])
        at = _plain_features(data, offsets, ranks, a, b) if b - a >= WINDOW else [a]
        owners.append(np.full(len(at), i)), places.append(np.array(at)), sizes.append(np.full(len(at), min(WINDOW, b - a)))
    owner, place, size = np.concatenate(owners), np.concatenate(places).astype(np.int64), np.concatenate(sizes)
    order = np.argsort(owner, kind="stable")
    owner, place, size = owner[order], place[order], size[order]
    value, power = size.astype(np.uint64), np.uint64(1)
    for k in range(WINDOW):
        value += np.where(k < size, _BYTE[data[np.minimum(place + k, len(data) - 1)]] * power if len(data) else np.uint64(0), np.uint64(0))
        power = np.uint64(int(power) * int(_BASE) & (1 << 64) - 1)
    value = mix(value)
    per = np.bincount(owner, minlength=count)
    chain = -(-per // PER_FILTER)
    first_filter, first_feature = np.cumsum(chain) - chain, np.cumsum(per) - per
    filter_of = first_filter[owner] + (np.arange(len(owner)) - first_feature[owner]) // PER_FILTER
    bits = np.zeros((int(chain.sum()), BITS), bool)
    for k in range(HASHES):
        bits[filter_of, ((value >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1, bitorder="little")
    return [packed[a : a + c] for a, c in zip(first_filter.tolist(), chain.tolist(), strict=True)]


def encode(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; 1 for equal chains, 0 where just one of them is empty."""
    if a.shape == b.shape and a.tobytes() == b.tobytes():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for at in range(0, len(a), 64):
        own = np.unpackbits(a[at : at + 64], axis=1).astype(np.float32)
        ones_a, best = own.sum(1), np.zeros(len(own))
        for to in range(0, len(b), 1024):
            other = np.unpackbits(b[to : to + 1024], axis=1).astype(np.float32)
            ones_b = other.sum(1)
            most = np.minimum(ones_a[:, None], ones_b[None, :])
            chance = ones_a[:, None] * ones_b[None, :] / BITS
            chance = chance + CHANCE * (most - chance)
            best = np.maximum(best, np.clip((own @ other.T - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(1))
        total += float(best.sum())
    return min(1.0, total / len(a))


def fingerprints(docs: DataFrame, ranks: Ranks, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of each row's whole text; a null text counts as empty, whose fingerprint is "".

    Repeated rows are returned one by one, an empty table gives an empty result, other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE):
            made = [encode(c) for c in filters(batch.column("text"), ranks)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def with_next(docs: DataFrame, step, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``step(ids, texts, next_texts)`` over runs of rows in descending id order (whole numbers), each with the next one's text.

    After the last row comes the first. Rows of one id are in the order of their texts, null ids
    are last. Texts are shuffled once: ranges of ids are dealt to tasks, and the first document of
    each range is sent along with the range before it. ``step`` returns an Arrow batch.
    """
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    parts = scratch.partitions(spark)
    cuts = np.unique(np.array(rows.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else [], np.float64))

    def dealt(ids: pa.Array) -> np.ndarray:  # 0 for the greatest ids
        values = ids.cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
        return len(cuts) - np.searchsorted(cuts, values, side="right")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(dealt(batch.column("doc_id")), pa.int32()), batch.column("doc_id")], ["part", "doc_id"])

    # one row per range, so as many as shuffle partitions
    first = rows.select("doc_id").mapInArrow(heads, "part int, doc_id long").groupBy("part").agg(F.max("doc_id").alias("head")).orderBy("part").collect()
    before = {r.head: first[k - 1].part for k, r in enumerate(first)}  # the first range's head goes to the last range
    known = pa.array([h for h in before if h is not None], pa.int64())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            part = dealt(ids)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.zeros(len(ids), np.int8)), ids, batch.column("text")], ["part", "late", "doc_id", "text"])
            sent = pc.is_in(ids, value_set=known)
            if None in before:
                sent = pc.or_(sent, ids.is_null())
            again = batch.filter(sent)
            if again.num_rows:
                to = [before[i] for i in again.column("doc_id").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(np.ones(len(to), np.int8)), *again.columns], ["part", "late", "doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows that wait for the next one's text
        size = 0
        for batch in slices(batches, most=SLICE):
            for part, late, i, text in zip(*(batch.column(c).to_pylist() for c in ("part", "late", "doc_id", "text")), strict=True):
                if late:
                    if held and held[0][0] == part:
                        yield flush(held, text)
                        held, size = [], 0
                    continue
                held.append((part, i, text))
                size += len(text)
                if size >= SLICE and len(held) > 1:
                    yield flush(held[:-1], text)
                    held, size = held[-1:], len(text)

    def flush(held: list[tuple], after: str) -> pa.RecordBatch:
        texts = [t for _, _, t in held]
        return step([i for _, i, _ in held], texts, [*texts[1:], after])

    moved = rows.mapInArrow(deal, "part int, late byte, doc_id long, text string").repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", "late", F.col("doc_id").desc_nulls_last(), "text")
    return moved.mapInArrow(run, schema)


def edited(text: str, after: str) -> str:
    """``text`` with its last half of code points replaced by the first as many of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def edits(docs: DataFrame, ranks: Ranks, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next text's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def step(ids: list, texts: list[str], after: list[str]) -> pa.RecordBatch:
        changed = [edited(t, a) for t, a in zip(texts, after, strict=True)]
        chains = filters(pa.array([*texts, after[-1]], pa.large_string()), ranks)
        others = filters(pa.array(changed, pa.large_string()), ranks)
        rows = [
            (i, len(t), hashlib.sha256(c.encode()).hexdigest(), encode(own), encode(other), likeness(own, other), likeness(own, nxt))
            for i, t, c, own, other, nxt in zip(ids, texts, changed, chains, others, chains[1:], strict=False)
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, step, schema, id_col, text_col)
