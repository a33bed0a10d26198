"""Ids of byte-level BPE by the tokenizers library, with bounded tables of what was seen before.

The pre-tokeniser of this vocabulary always starts a pre-token at a single space between two
characters that are no white space, so a text is cut there into chunks whose ids can be put
together. A new chunk of common characters is cut into pre-tokens and each new pre-token goes to the
library's BPE model once; other chunks (odd white space, rare characters, an added token's string)
go through the library's whole ``encode``.
"""

from __future__ import annotations

import itertools
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import regex

from barforge.llm.chunks import Known, gathered
from barforge.llm.shingles import buffers

#: Chunks that a worker's table holds at most; its pre-tokens are 3/8 of that, twice.
CHUNKS = 400_000
_COMMON = "!-~¡-ɏ–—‘’“”…"  # classes of these characters are the same in every Unicode version
_SIMPLE = re.compile(rf" ?[{_COMMON}]+(?:\n[{_COMMON}]+)*")
#: The public pre-token pattern of byte-level BPE.
_PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_encoders: dict[tuple[str, int], "ByteChunks"] = {}


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# UTF-8 of characters that are no white space in any library's tables: visible ASCII, U+00C0 to
# U+07FF, U+4000 and up, and the dashes, quotes and dots of _COMMON (E2 80 and one of _TAIL).
_ASCII, _LEAD2, _LEAD3, _LEAD4 = _bytes((0x21, 0x7E)), _bytes((0xC3, 0xDF)), _bytes((0xE4, 0xEF)), _bytes((0xF0, 0xF4))
_MORE = _bytes((0x80, 0xBF))
_TAIL = _bytes(*((ord(c) & 0x3F | 0x80,) * 2 for c in "–—‘’“”…"))


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks start in the UTF-8 of some texts: at each text, and at each single space inside it."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    at = np.flatnonzero(data == 0x20)
    at = at[~edge[at] & ~edge[at + 1]]  # characters of the same text on both sides
    ahead = lambda k: data[np.minimum(at + k, n - 1)]
    back = lambda k: data[np.maximum(at - k, 0)]
    a, b, c = ahead(1), back(1), back(2)
    after = _ASCII[a] | _LEAD2[a] | _LEAD3[a] | _LEAD4[a]
    odd = np.flatnonzero(~after & (a == 0xE2))
    if len(odd):
        after[odd] = (ahead(2)[odd] == 0x80) & _TAIL[ahead(3)[odd]]
    before = _ASCII[b] | (_MORE[b] & _LEAD2[c])
    if not before.all():
        d, e = back(3), back(4)
        before |= _MORE[b] & _MORE[c] & (_LEAD3[d] | (_MORE[d] & _LEAD4[e]) | ((d == 0xE2) & (c == 0x80) & _TAIL[b]))
    edge[:] = False
    edge[offsets[:-1][np.diff(offsets) > 0]] = True
    edge[at[before & after]] = True
    return np.flatnonzero(edge[:n])


class ByteChunks:
    def __init__(self, path: str, chunks: int = CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.size = self.library.get_vocab_size()
        self.model = self.library.model
        self.letters = _letters()
        self.parts: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}  # of this generation, of the last
        self.most_parts = chunks * 3 // 8
        self.known = Known(self._learn, chunks, np.uint32)
        # an added token inside a chunk is found there as it is in the whole text
        self.cuts = not any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added) and self._cuts()

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _pre_token(self, part: str) -> bytes:
        """Ids of one pre-token by the library's model, which takes bytes as letters."""
        if part.isascii() and part.isprintable():  # a space is the one byte among them that has another letter
            letters = part.replace(" ", self.letters[32])
        else:
            letters = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _cuts(self) -> bool:
        """The boundaries above hold for this vocabulary; else every text goes to the library whole."""
        probe = ["It's", " 12ab!?", " don't\nÜber--x", " .", " ªx²½"]
        cut = [np.frombuffer(self._pre_token(p), np.uint32).tolist() for c in probe for p in _PRE.findall(c)]
        return self._whole("".join(probe)) == list(itertools.chain.from_iterable(cut))

    def _part_ids(self, parts: list[str]) -> list[bytes]:
        if len(self.parts[0]) > self.most_parts:
            self.parts = {}, self.parts[0]
        now, last = self.parts
        out = []
        for p in parts:
            ids = now.get(p)
            if ids is None:
                ids = now[p] = last.get(p) or self._pre_token(p)
            out.append(ids)
        return out

    def _learn(self, fresh: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        simple = [c for c in fresh if _SIMPLE.fullmatch(c) and not any(a in c for a in self.added)]
        plain = [c for c in simple if c[0] == " "]
        rest = [c for c in simple if c[0] != " "]  # a text's first chunk
        odd = [] if len(simple) == len(fresh) else sorted(set(fresh) - set(simple))
        # each plain chunk starts a pre-token, so all of them are cut in one go
        parts = _PRE.findall("".join(plain))
        ids = self._part_ids(parts)
        ends = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))
        owner = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))))
        size = np.bincount(owner, np.fromiter(map(len, ids), np.int64, len(ids)), len(plain)).astype(np.int64)
        ids += [b"".join(self._part_ids(_PRE.findall(c))) for c in rest] + [array("I", self._whole(c)).tobytes() for c in odd]
        others = np.fromiter(map(len, ids[len(parts) :]), np.int64, len(rest) + len(odd))
        return plain + rest + odd, np.frombuffer(b"".join(ids), np.uint32), np.r_[size, others] // 4

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """uint32 ids of all texts in a row, and where each text's start (and the last one's end)."""
        if not self.cuts:
            whole = [self._whole(t) for t in texts.to_pylist()]
            return np.array(list(itertools.chain.from_iterable(whole)), np.uint32), np.cumsum([0, *map(len, whole)])
        data, offsets = buffers(texts)
        return gathered(self.known, data, offsets, chunk_starts(data, offsets))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text, as ``Tokenizer.encode(text, add_special_tokens=False)``."""
        flat, ends = self.encode_array(pa.array(texts, pa.large_string()))
        return np.split(flat, ends[1:-1]) if texts else []


def _letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def encoder(path: str, chunks: int = CHUNKS) -> ByteChunks:
    """This worker's encoder, whose table holds ``chunks`` at most: that sets memory and time, never ids."""
    if (path, chunks) not in _encoders:
        _encoders[path, chunks] = ByteChunks(path, chunks)
    return _encoders[path, chunks]
