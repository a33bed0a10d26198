"""Language of web pages by Bayesian fusion of evidence.

* Text: log likelihoods of hashed byte trigrams under a model of each language, counted over all
  labelled documents. Neighbouring trigrams are not independent, so a page's mean log likelihood
  counts as ``TRIGRAMS`` independent ones at most.
* Declared markup language (the ``lang`` of ``<html>``) and address suffix (a two-letter first path
  segment, else the top-level domain): the probability of each value under each language, counted
  from the text posteriors of all pages that have it, with ``PSEUDO`` pages of smoothing.
* Host prior: the text posteriors of the host's other pages, shrunk towards those of its domain,
  which are shrunk towards those of all pages, by ``PSEUDO`` pages at each step.

All counts are grouped sums with partial aggregation; they are joined back by broadcast where they
are counted to be few, else by a shuffle whose skewed keys can be split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm import scratch
from barforge.llm.shingles import SEGMENT, buffers
from barforge.llm.sources import slices

BUCKETS = 4096
TRIGRAMS = 60
PSEUDO = 4.0
BROADCAST_ROWS = 200_000
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed trigrams of folded bytes, a row for each text; runs of other bytes are one space."""
    data, offsets = buffers(texts)
    n = len(offsets) - 1
    out = np.zeros(n * BUCKETS, np.int64)
    last, last_owner = np.empty(0, np.uint32), np.empty(0, np.int64)  # the last two that the segments before kept
    for low in range(0, len(data), SEGMENT):
        folded = _FOLD[data[low : low + SEGMENT]]
        owner = np.searchsorted(offsets, np.arange(low, low + len(folded)), side="right") - 1
        before, owner_before = np.r_[last[-1:], folded], np.r_[last_owner[-1:], owner]
        keep = np.ones(len(before), bool)
        keep[1:] = (before[1:] != 32) | (before[:-1] != 32) | (owner_before[1:] != owner_before[:-1])
        keep = keep[len(before) - len(folded) :]
        d, owner = np.r_[last, folded[keep]], np.r_[last_owner, owner[keep]]
        if len(d) > 2:
            code = ((d[:-2] * np.uint32(0x9E3779B1)) ^ (d[1:-1] * np.uint32(0x85EBCA77)) ^ (d[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F) >> np.uint32(20)
            inside = owner[:-2] == owner[2:]
            out += np.bincount(owner[:-2][inside] * BUCKETS + code[inside], minlength=n * BUCKETS)
        last, last_owner = d[-2:], owner[-2:]
    return out.reshape(n, BUCKETS)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # buckets x languages
    trigrams: int = TRIGRAMS

    def posteriors(self, texts: pa.Array) -> np.ndarray:
        """Under equal priors; uniform for a text without trigrams."""
        counts = trigram_counts(texts)
        n = counts.sum(1, keepdims=True)
        score = (counts @ self.log_p) / np.maximum(n, 1) * np.minimum(n, self.trigrams)
        p = np.exp(score - score.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", trigrams: int = TRIGRAMS) -> TextModel:
    """Trigram frequencies of each language over all documents with a language and a text.

    ``trigrams`` is the number of independent ones that a text counts as at most.

    Without any, the model has the one language "und".
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in slices(batches, rows=256):
            counts = trigram_counts(batch.column("text"))
            names = np.array(batch.column("lang").to_pylist())
            for name in np.unique(names).tolist():
                seen[name] = seen.get(name, 0) + counts[names == name].sum(0)
        for name, total in seen.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], ["lang", "bucket", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    # BUCKETS rows for each language
    got = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = tuple(sorted({r.lang for r in got})) or ("und",)
    counts = np.full((BUCKETS, len(languages)), 0.5)
    for r in got:
        counts[r.bucket, languages.index(r.lang)] += r.n
    return TextModel(languages, np.log(counts / counts.sum(0)), trigrams)


def evidence(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, domain, declared, suffix, p`` (text posteriors in the order of the model's languages).

    What a page does not tell is "", nulls included; a page without trigrams has equal posteriors.
    Rows that repeat are returned one by one, other columns are not looked at.
    """
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.coalesce(F.col(url_col), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " "), r"&#?\w{1,8};", " ")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    segment = F.lower(F.regexp_extract(url, r"^[^:]+://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    suffix = F.when(segment != "", F.concat(F.lit("/"), segment)).otherwise(F.regexp_extract(host, r"\.([a-z]+)$", 1))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)).alias("declared"),
        suffix.alias("suffix"),
        text.alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=256):
            p = model.posteriors(batch.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], flat], [*batch.schema.names[:-1], "p"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, domain string, declared string, suffix string, p array<double>")


def _sums(rows: DataFrame, languages: int, *keys: str) -> DataFrame:
    """Text posteriors summed by key, one array."""
    sums = [F.sum(F.col("p")[k]).alias(f"s{k}") for k in range(languages)]
    return rows.groupBy(*keys).agg(*sums).select(*keys, F.array(*[f"s{k}" for k in range(languages)]).alias("sums"))


def _joined(rows: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
    table = scratch.table(table.withColumnRenamed("sums", name), "language-" + name)
    return rows.join(F.broadcast(table) if table.count() <= BROADCAST_ROWS else table, key)


def identify(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, declared, suffix, text_lang, lang, score`` of each page.

    ``score`` is the fused posterior of ``lang``; ``text_lang`` is what the text alone says. Null or
    empty pages and addresses bring no evidence of their kind; with none at all the prior over all
    pages decides. Ties go to the language that is first in the alphabet. Repeated rows count and
    are returned one by one; an empty table gives an empty result.
    """
    n = len(model.languages)
    rows = scratch.table(evidence(pages, model, id_col, url_col, html_col), "language-evidence")
    world = _sums(rows, n).first()  # one row
    total = np.array([x or 0.0 for x in world.sums]) if world else np.zeros(n)
    globe = (total + 1) / (total.sum() + n)

    joined = rows
    for key, name in (("host", "of_host"), ("domain", "of_domain"), ("declared", "of_declared"), ("suffix", "of_suffix")):
        joined = _joined(joined, _sums(rows, n, key), key, name)
    size = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def others(name: str, k: int) -> Column:  # without the page's own vote
        return F.greatest(F.col(name)[k] - F.col("p")[k], F.lit(0.0))

    logs = []
    for k in range(n):
        domain = (others("of_domain", k) + PSEUDO * float(globe[k])) / (F.greatest(size("of_domain") - 1, F.lit(0.0)) + PSEUDO)
        prior = (others("of_host", k) + PSEUDO * domain) / (F.greatest(size("of_host") - 1, F.lit(0.0)) + PSEUDO)
        told = F.log(F.col("p")[k] + 1e-9) + F.log(F.when(F.col("host") == "", F.lit(float(globe[k]))).otherwise(prior))
        for key, name in (("declared", "of_declared"), ("suffix", "of_suffix")):
            # P(value | language) = P(language | value) P(value) / P(language); P(value) is the same for all
            given = (others(name, k) + PSEUDO * float(globe[k])) / (F.greatest(size(name) - 1, F.lit(0.0)) + PSEUDO)
            told = told + F.when(F.col(key) == "", F.lit(0.0)).otherwise(F.log(given / float(globe[k])))
        logs.append(told)
    scored = joined.withColumn("__log", F.array(*logs))
    top = F.array_max("__log")
    names = F.array(*[F.lit(x) for x in model.languages])
    pick = lambda a: F.get(names, F.array_position(a, F.array_max(a)).cast("int") - 1)
    return scored.select("page_id", "host", "declared", "suffix", pick(F.col("p")).alias("text_lang"), pick(F.col("__log")).alias("lang"), (1 / size(F.transform("__log", lambda x: F.exp(x - top)))).alias("score"))
