"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Metrics are columns computed once per document; a :class:`Rule` bounds a numerator by a share of a
denominator, both of them metrics, so every verdict is integer arithmetic. The compiled projection
has no user function and no shuffle: each row is judged by itself.

A null or empty text has 0 for every metric. Rows that repeat are judged row by row, an empty table
gives an empty result. Input columns may have any names; metrics are built under a prefix of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Function words of the corpus' languages.
STOP_WORDS = (
    "the of and to in is that it for was on are with as be by at this from or an have not",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "le la les de des et un une du en que qui est pour dans sur au par avec ce il plus ne se",
    "el la los las de que y en un una por con no para su se del al es lo como más o",
)


@dataclass(frozen=True)
class Rule:
    """``least <= numerator / denominator <= most``, in percent; holds for a denominator under ``from_``.

    Without a denominator the bounds are the numerator's own.
    """

    name: str
    numerator: str
    denominator: str | None = None
    least: int | None = None
    most: int | None = None
    from_: int = 1

    def column(self, metric) -> Column:
        value, unit, holds = metric(self.numerator), F.lit(1), F.lit(True)
        if self.denominator is not None:
            value, unit = 100 * value, metric(self.denominator)
        if self.least is not None:
            holds = holds & (value >= self.least * unit)
        if self.most is not None:
            holds = holds & (value <= self.most * unit)
        return holds if self.denominator is None else (unit < self.from_) | holds


#: Fails on its own, whatever the other rules say.
BASE = (
    Rule("enough_words", "n_words", least=20),
    Rule("few_repeats", "n_repeat_words", "n_words", most=30),
)
TABLE = (
    Rule("most_words", "n_words", most=2_000_000),
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=30),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=40),
    Rule("letters", "n_letters", "word_chars", least=60),
    Rule("capitals", "n_capitals", "n_letters", most=50, from_=50),
    Rule("shouts", "n_shouts", "n_words", most=20),
    Rule("stop_words", "n_stop_words", "n_words", least=2, from_=50),
    Rule("stutters", "n_stutters", "n_words", most=25, from_=20),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=40, from_=5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=90, from_=5),
)


def _size(items: Column) -> Column:
    return F.size(items).cast("long")


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``__m`` of the metrics."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumns({
        "__words": F.filter(F.split(text, SPACE), lambda w: w != ""),
        "__lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)),
    })
    words, lines, hashes = F.col("__words"), F.col("__lines"), F.col("__hashes")
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    out = out.withColumn("__hashes", F.transform(words, lambda w: F.xxhash64(w)))
    out = out.withColumn("__windows", F.when(F.size(words) > WINDOW, windows))
    w = F.col("__windows")
    # Texts without a repeated window, nearly all of them, skip the sorting. Sorted, windows of one
    # hash are neighbours; the places of those that have one cover the words to be counted.
    placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__placed", F.when(F.size(F.array_distinct(w)) < F.size(w), placed))
    s = F.col("__placed")
    again = F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)))
    out = out.withColumn("__places", F.sort_array(F.transform(again, lambda x: x["i"])))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        F.col("__places"),
        start,
        lambda a, i: F.struct((a["n"] + F.least(i - a["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    stop = sorted({v for line in STOP_WORDS for u in line.split() for v in (u, u.capitalize())})
    values = {
        "n_words": _size(words),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_lines": _size(lines),
        "n_dup_lines": _size(lines) - _size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_letters": _removed(text, "\\p{L}+"),
        "n_capitals": _removed(text, "\\p{Lu}+"),
        "n_shouts": F.regexp_count(text, F.lit("!!")),
        "n_stop_words": _size(F.filter(words, lambda v: v.isin(stop))),
        "n_stutters": _size(F.filter(hashes, lambda h, i: F.coalesce(h == F.get(hashes, i - 1), F.lit(False)))),
        "n_ellipsis_lines": _size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))),
        "n_bullet_lines": _size(F.filter(lines, lambda x: x.rlike("^[\\x20\\t]*[-*•]"))),
    }
    # A generator of one row: filters on the verdict stay above it, where they would otherwise be
    # moved below these projections and repeat their expressions within one another.
    made = F.array(F.struct(*[c.cast("long").alias(k) for k, c in values.items()]))
    return out.select("*", F.explode(made).alias("__m"))


def judge(docs: DataFrame, table: Sequence[Rule] = TABLE, base: Sequence[Rule] = BASE, text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, with ``__m``, ``__base_failed`` and ``__failed`` (names of the rules that fail)."""
    metric = lambda name: F.col("__m")[name]
    names = lambda rules: F.filter(F.array(*[F.when(~r.column(metric), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    out = metrics(docs, text_col).withColumns({"__base_failed": F.size(names(base)) > 0, "__failed": F.array_union(names(base), names(table))})
    return out.select(*[f"`{c}`" for c in docs.columns], "__m", "__base_failed", "__failed")


def keep(docs: DataFrame, table: Sequence[Rule] = TABLE, base: Sequence[Rule] = BASE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that fail no rule, with their own columns only."""
    return judge(docs, table, base, text_col).where(F.size("__failed") == 0).select(*[f"`{c}`" for c in docs.columns])
