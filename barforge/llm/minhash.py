"""Near-duplicates by MinHash: universal hash minima, bands, verified links, connected components.

1. Every text becomes its set of word-shingle hashes; ``BANDS * ROWS`` universal hashes
   ``a * x + b (mod 2**32)`` give its minima, hashed band by band. Texts with one and the same set
   are one *node* from here on, so copies cost one row each.
2. Nodes that share a band are a bucket. A bucket's least and greatest node are the partners a
   member may be linked with; of those over all its buckets, a member is compared with the two it
   shares most bands with. That is at most two pairs for each node, whatever a bucket's size.
3. Links are confirmed on full sets and joined to components.
4. Buckets whose members are in one component by now are settled. The others that have members in
   common, directly or by way of further ones, are a *family*: a node is in some seven open buckets
   but in one family. All members of a family in different components are compared on full sets, in
   blocks: the members of the largest component and the rest are dealt to blocks of bounded size,
   each block of the rest meets every block. Only links that join two components leave a task, never
   more than it has members. That sends a set to each block it meets; a family for which this is more
   than to send a set for each bucket it is in is taken apart again, and its buckets are compared in
   the same manner, each by itself. So work stays in proportion to memberships. Such a bucket of more
   than two blocks is first divided by rare shingles: of a set of ``n`` that needs ``t`` shared
   shingles, a partner of another component shares one of the ``m - t + 1`` rarest among the ``m``
   that occur in several components. Only members under the same rare shingle are compared, so a
   passage that many texts share without being alike brings none of them together.

The chance that two texts of similarity 0.8 share no band is (1 - 0.8**6)**48, under 5e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm import scratch, shingles
from barforge.llm.components import connected
from barforge.llm.sources import id_text, slices

BANDS, ROWS = 48, 6
#: Rows of two longs; as many are broadcast at most, more are shuffled.
BROADCAST_ROWS = 400_000
#: A block of step 4 has about so many members, or shingles where those are many.
BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 500_000
#: A family is compared whole if that sends at most as many sets as it has memberships in open buckets, times this.
FAMILY_SENDS = 1


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    n = BANDS * ROWS
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def minima(values: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash function over a non-empty set."""
    a, b = family[0][:, None], family[1][:, None]
    x = (values >> np.uint64(32)).astype(np.uint32)
    least = None
    for at in range(0, len(x), 2048):
        part = (a * x[None, at : at + 2048] + b).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = shingles.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def signatures(rows: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, bands``; a text without words has no digest and no bands.

    Rows are signed one by one, repeated ones and null ids included; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family()
        for batch in slices(batches):
            n, digest, bands = [], [], []
            for values in shingles.sets(batch.column("text"), size):
                n.append(len(values))
                digest.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                bands.append(band_keys(minima(values, family)) if len(values) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, bands array<long>")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """``id, values``: each row's set of shingle hashes, empty for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [x.view(np.int64) for x in shingles.sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["id", "values"])

    return rows.mapInArrow(run, f"id {rows.schema['doc_id'].dataType.simpleString()}, values array<long>")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _cross_links(threshold: int):
    """Links between members of different components in a group of blocks, a spanning set of them."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, comps, minor = group["rep"].to_numpy(), group["component"].to_numpy(), group["minor"].to_numpy()
        own = [np.asarray(v, np.int64) for v in group["values"]]
        size = np.array([len(v) for v in own])
        everything = np.concatenate(own)
        owner = np.repeat(np.arange(len(own)), size)
        root = np.unique(comps, return_inverse=True)[1]
        links = []
        for y in np.flatnonzero(minor):
            open_ = (root != root[y]) & (100 * np.minimum(size, size[y]) >= threshold * np.maximum(size, size[y]))
            if not open_.any():
                continue
            mine = np.sort(own[y])
            at = open_[owner]
            seen = everything[at]
            place = np.minimum(np.searchsorted(mine, seen), len(mine) - 1)
            shared = np.bincount(owner[at], weights=mine[place] == seen, minlength=len(own)).astype(np.int64)
            for x in np.flatnonzero(open_ & (100 * shared >= threshold * (size + size[y] - shared))):
                if root[x] != root[y]:
                    links.append((ids[x], ids[y]))
                    root[root == root[x]] = root[y]
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _plan(at: DataFrame) -> DataFrame:
    """``band, lo, major, nb_major, nb_minor, sent``: least member, largest component and numbers of blocks of each bucket of several components.

    ``sent`` is how many sets go to all its blocks together. Of buckets with the same members, one is returned.
    """
    mixed = at.groupBy("band").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("k"), F.sum(F.xxhash64("rep").cast("decimal(20)")).alias("s"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x")).where("c < d")
    open_ = mixed.groupBy("k", "s", "x").agg(F.min("band").alias("band"))
    counted = at.join(open_.select("band"), "band", "left_semi").groupBy("band", "component").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.min("rep").alias("lo"))
    blocks = lambda k, n: F.greatest(F.lit(1), F.ceil(k / BLOCK_MEMBERS), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    plan = counted.groupBy("band").agg(F.max_by("component", "k").alias("major"), F.max("k").alias("mk"), F.max_by("n", "k").alias("mn"), F.sum("k").alias("k"), F.sum("n").alias("n"), F.min("lo").alias("lo"))
    plan = plan.withColumn("nb_major", blocks(F.col("mk"), F.col("mn"))).withColumn("nb_minor", blocks(F.col("k") - F.col("mk"), F.col("n") - F.col("mn")))
    return plan.select("band", "lo", "major", "nb_major", "nb_minor", F.expr("k * nb_minor + (k - mk) * (nb_major - 1)").alias("sent"))


def _rare(members: DataFrame, values: DataFrame, threshold: int) -> DataFrame:
    """``band, rep, n, component`` of members under each of their rarest shingles (``band``), as step 4 says."""
    spread = values.withColumnRenamed("id", "rep").join(members, "rep").select("rep", "component", F.size("values").alias("n"), F.explode("values").alias("v"))
    shared = spread.groupBy("v").agg(F.count("*").alias("f"), F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("v", "f")
    held = spread.join(shared, "v").groupBy("rep", "component", "n").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("s"))  # at most a set's size
    first = F.size("s") - F.expr(f"({threshold} * n + 99) div 100").cast("int") + 1
    return held.where(first > 0).select("rep", "component", F.col("n").cast("long").alias("n"), F.explode(F.transform(F.slice("s", 1, F.greatest(first, F.lit(1))), lambda x: x["v"])).alias("band"))


def _compared(at: DataFrame, plan: DataFrame, values: DataFrame, threshold: int) -> DataFrame:
    """Links ``a, b`` between members of different components, block by block of each planned bucket."""
    dealt = at.join(_small(plan, plan.count()), "band").withColumn("minor", F.col("component") != F.col("major"))
    i = F.pmod(F.xxhash64("rep"), F.when(F.col("minor"), F.col("nb_minor")).otherwise(F.col("nb_major"))).cast("int")
    # a group is a block x of the rest with block y: of the rest from x + 1 on, of the largest from -1 down, where x meets itself too
    of_minor = F.concat(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("nb_minor") - 1), lambda j: j != i), lambda j: F.struct(F.least(i, j).alias("x"), F.greatest(i, j).alias("y"))),
        F.transform(F.sequence(F.lit(1), F.col("nb_major")), lambda j: F.struct(i.alias("x"), (-j).alias("y"))),
    )
    of_major = F.transform(F.sequence(F.lit(0), F.col("nb_minor") - 1), lambda j: F.struct(j.alias("x"), (-i - 1).alias("y")))
    spread = dealt.select("band", "rep", "component", "minor", F.explode(F.when(F.col("minor"), of_minor).otherwise(of_major)).alias("g")).select("band", "g.x", "g.y", "rep", "component", "minor")
    kind = values.schema["id"].dataType.simpleString()
    return spread.join(values.withColumnRenamed("id", "rep"), "rep").groupBy("band", "x", "y").applyInPandas(_cross_links(threshold), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row, for shingles of ``size`` words.

    Texts are linked from a Jaccard similarity of ``threshold`` percent on. Words are runs of
    anything but ASCII white space, A-Z in lower case. A text without words (null, empty, blank) is
    linked with nothing. ``component_id`` is the least id reachable, ``kept`` tells whether it is
    the row's own. Ids may be null, repeated or of any type that can be ordered: rows are then
    numbered in the order of their ids, nulls last, and linked by number, so each row has its own
    text's component; of a component without any id the first row is kept. An empty table gives an
    empty result; other columns are not looked at.
    """
    rows = id_text(docs, id_col, text_col)
    signed = scratch.table(signatures(rows, size), "minhash-signatures")
    if _names_rows(signed):
        return _judged(rows, signed, size, threshold)
    numbered = _numbered(rows, "doc_id")
    texts = numbered.select(F.col("__row").alias("doc_id"), "text")
    judged = _judged(texts, scratch.table(signatures(texts, size), "minhash-signatures"), size, threshold)
    name = lambda row, of: numbered.select(F.col("__row").alias(row), F.col("doc_id").alias(of))
    named = judged.withColumnRenamed("doc_id", "row").join(name("row", "doc_id"), "row").join(name("component_id", "component"), "component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.col("component").isNull() & F.col("kept"))
    return named.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def _names_rows(signed: DataFrame) -> bool:
    """Whether each id is a number that stands for one row."""
    if signed.schema["doc_id"].dataType.typeName() not in ("long", "integer", "short", "byte"):
        return False
    return signed.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()


def _numbered(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with ``__row``, a number that follows the order of ids, nulls last; written, so that it stays."""
    order = docs.orderBy(F.col(id_col).asc_nulls_last(), F.monotonically_increasing_id())
    return scratch.table(order.withColumn("__row", F.monotonically_increasing_id()), "minhash-numbered")


def _judged(rows: DataFrame, signed: DataFrame, size: int, threshold: int) -> DataFrame:
    """``near_duplicates`` of rows whose ids are unique numbers."""
    nodes = scratch.table(signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "minhash-nodes")
    with scratch.passing(rows.sparkSession) as table:
        components = _components(rows, nodes, size, threshold, table)
    of_node = nodes.select("digest", "rep").join(components.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(of_node, "digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _components(rows: DataFrame, nodes: DataFrame, size: int, threshold: int, table) -> DataFrame:
    """``id, component`` of the nodes that are linked with others; ``table`` writes what later steps do not read."""
    banded = nodes.select("rep", "n", F.explode("bands").alias("band"))
    shared = table(banded.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi"), "minhash-buckets")
    members = table(banded.join(_small(shared, shared.count()), "band"), "minhash-members")
    partner = members.select("rep", F.explode(F.array("lo", "hi")).alias("other")).where("rep <> other").groupBy("rep", "other").count()
    best = partner.groupBy("rep").agg(F.max_by("other", F.struct("count", "other")).alias("p"), F.max_by("other", F.struct("count", -F.col("other"))).alias("q"))
    pairs = best.select(F.explode(F.array_distinct(F.array("p", "q"))).alias("o"), "rep").select(F.least("rep", "o").alias("a"), F.greatest("rep", "o").alias("b")).distinct()

    involved = table(members.select(F.col("rep").alias("doc_id")).distinct(), "minhash-involved")
    values = table(_sets(rows.join(_small(involved, involved.count()), "doc_id", "left_semi"), size), "minhash-sets")
    left, right = values.select(F.col("id").alias("a"), F.col("values").alias("va")), values.select(F.col("id").alias("b"), F.col("values").alias("vb"))
    both = F.size(F.array_intersect("va", "vb"))
    links = pairs.join(left, "a").join(right, "b").where(100 * both >= threshold * (F.size("va") + F.size("vb") - both)).select("a", "b")
    found = connected(links)

    at = members.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("band", "rep", "n", F.coalesce("component", "rep").alias("component"))
    at = table(at, "minhash-members-joined")
    plan = table(_plan(at), "minhash-open")
    if plan.isEmpty():
        return found
    first = plan.select("band", "lo")
    linked = connected(at.join(_small(first, plan.count()), "band").select(F.col("rep").alias("a"), F.col("lo").alias("b")))
    named = first.join(linked.withColumnRenamed("id", "lo"), "lo").select("band", F.col("component").alias("family"))
    of_family = table(at.join(_small(named, plan.count()), "band"), "minhash-of-family")
    whole = of_family.select(F.col("family").alias("band"), "rep", "n", "component").distinct()
    memberships = of_family.groupBy(F.col("family").alias("band")).agg(F.count("*").alias("memberships"))
    families = table(_plan(whole).join(memberships, "band"), "minhash-families")
    fits = F.col("sent") <= FAMILY_SENDS * F.col("memberships")
    more = _compared(whole, families.where(fits), values, threshold)
    apart = families.where(~fits).select(F.col("band").alias("family"))
    if not apart.isEmpty():
        at = table(of_family.join(apart, "family", "left_semi").select("band", "rep", "n", "component"), "minhash-apart")
        plan = table(plan.join(at.select("band").distinct(), "band", "left_semi"), "minhash-apart-open")
        large = F.col("nb_major") + F.col("nb_minor") > 2
        more = more.unionByName(_compared(at, plan.where(~large), values, threshold))
        if not plan.where(large).isEmpty():
            rare = table(_rare(at.join(plan.where(large).select("band"), "band", "left_semi").select("rep", "component").distinct(), values, threshold), "minhash-rare")
            more = more.unionByName(_compared(rare, table(_plan(rare), "minhash-open"), values, threshold))
    return connected(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))


def keep_one(docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one of the least id, with its own columns; all rows of texts without words.

    Where ids are null, repeated or no numbers, rows are numbered in the order of their ids, nulls
    last, and judged by number: of equal rows one stays. An empty table stays empty.
    """
    rows = id_text(docs, id_col, text_col)
    signed = scratch.table(signatures(rows, size), "minhash-signatures")
    if not _names_rows(signed):
        return keep_one(_numbered(docs, id_col), size, threshold, "__row", text_col).drop("__row")
    judged = scratch.table(_judged(rows, signed, size, threshold).where("not kept").select(F.col("doc_id").alias("__gone")), "minhash-gone")
    return docs.join(_small(judged, judged.count()), F.col(id_col) == F.col("__gone"), "left_anti")
