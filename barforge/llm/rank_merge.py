"""Token counts by rank-synchronous merging of ragged arrays.

Pre-tokens (white-space chunks, which no piece crosses) are held as one flat array of piece
numbers with a sequence number for each symbol. A round finds every sequence's best-ranked
adjacent pair, leftmost among equals, and merges it in all sequences at once; where no pair that
the merged piece can form ranks better than the piece itself, all of the pair's occurrences in the
sequence are merged in the round. Sequences leave when no pair is left. A sequence of more than
``LONG`` symbols (a chunk without white space) would take a round for nearly every one of them: it
is held as a linked array with a heap of its pairs by rank and place, and a merge touches just its
neighbours. What survives is counted: one token for a known piece, one for each UTF-8 byte of an
unknown character.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.chunks import Known, gathered
from barforge.llm.pieces import MARK, chunk_table, marked
from barforge.llm.sources import TOKENIZER_BYTES, id_text, slices

WORDS = 400_000
LONG = 512
NONE = np.iinfo(np.int64).max
_mergers: dict[str, "Merger"] = {}


class Merger:
    """Pair ranks of one sentencepiece BPE model."""

    def __init__(self, path: str):
        model = chunk_table(path).model
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        name = {i: model.id_to_piece(i) for i in normal}
        number = {p: i for i, p in name.items()}
        self.single = {p: i for p, i in number.items() if len(p) == 1}
        self.size = size + 1  # one number more, for characters that are no piece
        scores = {i: model.get_score(i) for i in normal}
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        left, right, into = [], [], []
        for i, p in name.items():
            for cut in range(1, len(p)):
                a, b = number.get(p[:cut]), number.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), into.append(i)
        into_a = np.array(into, np.int64)
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.into = keys[order], into_a[order]
        self.rank = np.full(self.size, NONE, np.int64)
        for i, s in scores.items():
            self.rank[i] = ranks[s]
        best = np.full(self.size, NONE, np.int64)  # of the pieces that a piece is part of
        for part in (np.array(left, np.int64), np.array(right, np.int64)):
            np.minimum.at(best, part, self.rank[into_a])
        self.safe = best > self.rank
        self.pairs = dict(zip(self.keys.tolist(), zip(self.rank[self.into].tolist(), self.into.tolist(), strict=True), strict=True))
        self.known = Known(self._learn, WORDS, np.int64)

    def _pairs(self, sym: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """The piece that each symbol forms with the next of its sequence, or -1."""
        key = sym[:-1] * self.size + sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (seq[:-1] == seq[1:]), self.into[at], -1)

    def counts(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word, the dummy prefix included."""
        texts = [MARK + w.replace(" ", MARK) for w in words]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        seq = np.repeat(np.arange(len(texts)), lengths)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters, back = np.unique(points, return_inverse=True)
        sym = np.array([self.single.get(chr(c), self.size - 1) for c in letters], np.int64)[back]
        size_of = np.where(letters < 0x80, 1, np.where(letters < 0x800, 2, np.where(letters < 0x10000, 3, 4)))[back]
        unknown = sym == self.size - 1
        if len(texts) == 1 and len(sym) > LONG:
            return np.array([self._linked(sym) + int(np.where(unknown, size_of - 1, 0).sum())])
        total = np.bincount(seq, weights=np.where(unknown, size_of - 1, 0), minlength=len(texts)).astype(np.int64)
        while len(sym) > 1:
            made = self._pairs(sym, seq)
            rank = np.where(made >= 0, self.rank[made], NONE)
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            group = np.cumsum(np.r_[True, seq[1:] != seq[:-1]]) - 1
            least = np.minimum.reduceat(np.r_[rank, NONE], first)
            live = least < NONE
            if not live.all():  # finished sequences are counted and leave
                ended = ~live[group]
                total += np.bincount(seq[ended], minlength=len(texts))
                keep = ~ended
                sym, seq = sym[keep], seq[keep]
                continue
            hit = np.flatnonzero(rank == least[group[:-1]])
            lead = hit[np.r_[True, group[hit[1:]] != group[hit[:-1]]]]  # leftmost in each sequence
            chosen = np.zeros(len(sym), bool)
            chosen[lead] = True
            target = np.full(len(first), -1, np.int64)
            target[group[lead]] = made[lead]
            more = hit[(made[hit] == target[group[hit]]) & self.safe[made[hit]]]
            if len(more) > len(lead):  # same pair again: take every other one of overlapping runs
                pair = sym[more] * self.size + sym[more + 1]
                lead_pair = np.zeros(len(first), np.int64)
                lead_pair[group[lead]] = sym[lead] * self.size + sym[lead + 1]
                more = more[pair == lead_pair[group[more]]]
                run = np.cumsum(np.r_[True, np.diff(more) != 1]) - 1
                start = np.flatnonzero(np.r_[True, np.diff(more) != 1])
                chosen[more[(np.arange(len(more)) - start[run]) % 2 == 0]] = True
            at = np.flatnonzero(chosen)
            sym = sym.copy()
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
        return total + np.bincount(seq, minlength=len(texts))

    def _linked(self, symbols: np.ndarray) -> int:
        """Surviving symbols of one long sequence."""
        n = left = len(symbols)
        made = self._pairs(symbols, np.zeros(n, np.int64))
        place = np.flatnonzero(made >= 0)
        heap = (self.rank[made[place]] * n + place).tolist()
        heapify(heap)
        sym, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, at = divmod(heappop(heap), n)
            to = after[at]
            if sym[at] < 0 or to >= n:
                continue
            pair = self.pairs.get(sym[at] * self.size + sym[to])
            if pair is None or pair[0] != rank:
                continue  # its symbols have been merged with others
            sym[at], sym[to], after[at] = pair[1], -1, after[to]
            if after[to] < n:
                before[after[to]] = at
            left -= 1
            for i, j in ((before[at], at), (at, after[at])):
                if i >= 0 and j < n and (pair := self.pairs.get(sym[i] * self.size + sym[j])):
                    heappush(heap, pair[0] * n + i)
        return left

    def _learn(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Counts of new chunks, each of which starts with a space, the marker of its own."""
        chunks = sorted(chunks, key=len)  # sequences of like lengths end together
        found, at = [np.empty(0, np.int64)], 0
        while at < len(chunks):
            end, held = at, 0
            while end < len(chunks) and (end == at or (held + len(chunks[end]) < 65_536 and len(chunks[end]) <= LONG)):
                held += len(chunks[end])
                end += 1
            found.append(self.counts([c[1:] for c in chunks[at:end]]))
            at = end
        return chunks, np.concatenate(found), np.ones(len(chunks), np.int64)

    def count_array(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        data, offsets, starts = marked(texts)
        of_chunk, ends = gathered(self.known, data, offsets, starts)
        total = np.r_[0, np.cumsum(of_chunk)]
        return total[ends[1:]] - total[ends[:-1]]

    def count(self, texts: list[str]) -> list[int]:
        return self.count_array(pa.array(texts, pa.large_string())).tolist()


def merger(path: str) -> Merger:
    if path not in _mergers:
        _mergers[path] = Merger(path)
    return _mergers[path]


def count(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row, over whole texts.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted row by row; an empty
    table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merger(model)
        for batch in slices(batches, most=TOKENIZER_BYTES, rows=65_536):
            texts = batch.column("text")
            n = pa.array(own.count_array(texts))
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, n], ["doc_id", "n_bytes", "n_tokens"])

    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
