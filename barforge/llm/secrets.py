"""Secret scans over a trigram inverted index, with built-in functions only.

Each rule's regular expression is turned into a Boolean query of lower-case trigrams that any match
must hold (alternatives are a disjunction, what follows one another a conjunction), kept as
branches: a document is a candidate of a rule if it holds every trigram of one of its branches. The
index has the postings (trigram, document) of just the trigrams that some branch asks for;
intersecting them is one aggregation. Candidates are verified with the expression itself. Rules
without a mandatory trigram scan every text.

Spans are code points, end exclusive. A null or empty text has no spans; rows that repeat an id are
scanned row by row (they share their candidate rules, which verification makes exact); null ids
are matched null-safely; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as sre  # the standard library's own parser of expressions
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm import scratch

#: A candidate table of so many rows at most (16 bytes each) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
#: Alternatives kept apart while trigrams are derived; beyond, a part counts as unknown.
ALTERNATIVES = 96


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans; those whose ``group`` has under ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=8, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),  # maximal runs: shorter ones would be dropped
)
MORE = (
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("cloud", r"AIza[0-9A-Za-z_-]+", least=39),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=32),
    Rule("login", r"://[^/\x00-\x20:@]+:[^/\x00-\x20:@]+@", least=8),
)
RULES = BASE + MORE


# --- Boolean trigram queries -------------------------------------------------------------------

Branches = frozenset  # of frozensets of trigrams; the empty branch holds for every text
ALL: Branches = frozenset({frozenset()})


def _least(branches) -> Branches:
    """Without branches that another one implies."""
    found = set(branches)
    return frozenset(b for b in found if not any(o < b for o in found))


def _both(a: Branches, b: Branches) -> Branches:
    made = _least(x | y for x in a for y in b)
    return made if len(made) <= ALTERNATIVES else min(a, b, key=len)


def _of_strings(strings) -> Branches:
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _walk(items) -> tuple[set[str] | None, Branches]:
    """The strings that ``items`` match, if few, and the query that any match satisfies."""
    exact: set[str] = {""}
    whole, query = True, ALL
    for op, arg in items:
        strings, own = _node(op, arg)
        if strings is not None and len(exact) * len(strings) <= ALTERNATIVES:
            exact = {a + b for a, b in itertools.product(exact, strings)}
            continue
        query, whole = _both(_both(query, _of_strings(exact)), own), False
        exact = strings if strings is not None else {""}
    return (exact if whole else None), _both(query, _of_strings(exact))


def _node(op, arg) -> tuple[set[str] | None, Branches]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, ALL
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, ALL
        return (chars, ALL) if len(chars) <= 8 else (None, ALL)
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op is sre.BRANCH:
        found = [_walk(x) for x in arg[1]]
        strings = None if any(s is None for s, _ in found) else set().union(*(s for s, _ in found))
        return strings, _least(b for _, q in found for b in q)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, query = _walk(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ALL
        if strings is not None and low == high and len(strings) == 1:
            return {next(iter(strings)) * low}, ALL
        return None, query if low else ALL
    if op is sre.AT or op is sre.ASSERT_NOT:
        return {""}, ALL
    return None, ALL


def trigram_query(rule: Rule) -> list[list[str]]:
    """Branches of trigrams, one of which every match of the rule holds; [] if none is mandatory."""
    _, query = _walk(_parser.parse(rule.pattern))
    return [] if frozenset() in query else sorted(sorted(b) for b in query)


# --- index, intersection, verification -----------------------------------------------------------


def index(docs: DataFrame, trigrams: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``(trigram, doc_id)`` of the given trigrams (numbers into the list) over whole texts.

    A null or empty text has no postings; rows that share an id have each their own; other columns are not looked at.
    """
    low = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("__low"))
    held = F.array_compact(F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return low.select("doc_id", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``__mask``: bit ``k`` is set if the postings allow a match of ``rules[k]``.

    Ids without postings are left out, null ids are one group, rows of one id share a mask.
    """
    spark = docs.sparkSession
    asked = [(k, b) for k, r in enumerate(rules) for b in trigram_query(r)]
    trigrams = sorted({t for _, b in asked for t in b})
    number = {t: i for i, t in enumerate(trigrams)}
    terms = [(i, k, len(b), number[t]) for i, (k, b) in enumerate(asked) for t in b]
    postings = scratch.table(index(docs, trigrams, id_col, text_col), "trigram-index")
    query = spark.createDataFrame(terms, "branch int, rule int, need int, trigram int")  # as large as the rules
    met = postings.join(F.broadcast(query), "trigram").groupBy("doc_id", "branch").agg(F.countDistinct("trigram").alias("n"), F.first("need").alias("need"), F.first("rule").alias("rule")).where("n = need")
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("__mask"))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """All matches as structs (start, end, kind number), leftmost and apart."""
    pattern = F.lit(rule.java)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.java, -1)
    empty = F.array().cast("array<struct<start:int,end:int,kind:int,size:int>>")
    parts = F.arrays_zip(F.slice(F.transform(between, lambda x: F.length(x)), 1, F.size(found)).alias("gap"), F.transform(found, lambda x: F.length(x)).alias("len"), F.transform(checked, lambda x: F.length(x)).alias("size"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(a: Column, p: Column) -> Column:
        begin = a["at"] + p["gap"]
        end = begin + p["len"]
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"), F.lit(number).alias("kind"), p["size"].alias("size")))).alias("spans"))

    return F.filter(F.aggregate(parts, start, step, lambda a: a["spans"]), lambda s: s["size"] >= rule.least)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``__spans``: structs (start, end, kind), kind a number into ``rules``.

    Ordered by start, then by the rules' order.
    """
    found = scratch.table(candidates(docs, rules, id_col, text_col), "trigram-candidates").withColumnRenamed("doc_id", "__id")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    text, mask = F.coalesce(F.col(text_col), F.lit("")), F.coalesce("__mask", F.lit(0).cast("long"))
    joined = docs.join(found, F.col(id_col).eqNullSafe(F.col("__id")), "left")
    per_rule = {}
    for k, rule in enumerate(rules):
        possible = mask.bitwiseAND(F.lit(1 << k).cast("long")) != 0 if trigram_query(rule) else text.rlike(rule.java)
        per_rule[f"__r{k}"] = F.when(possible, _spans(text, rule, k))
    out = joined.withColumns(per_rule)
    none = F.array().cast("array<struct<start:int,end:int,kind:int,size:int>>")
    spans = F.concat(*[F.coalesce(F.col(c), none) for c in per_rule])
    ordered = F.transform(F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return out.withColumn("__spans", ordered).select(*[f"`{c}`" for c in docs.columns], "__spans")


def listed(spans: Column, rules: Sequence[Rule]) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs``, every span of its text replaced by ``mark`` (overlapping ones by one).

    A null text stays null, repeated rows are redacted one by one, an empty table stays empty.
    """
    found = scan(docs, rules, id_col, text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col(text_col)

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        grown = F.when(fresh, F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), grown.alias("out"))

    clean = F.aggregate("__spans", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size("__spans") > 0, clean).otherwise(text)).select(*[f"`{c}`" for c in docs.columns])
