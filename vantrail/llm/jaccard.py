"""Near duplicates by the Jaccard similarity of word shingles: a T-occurrence search.

Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets of shingles; a class
is what links connect. A partner of a set of n shingles has at least T = ceil(n * num / den)
of them (a T-occurrence problem), and at least ``k`` of the first n - T + k in any fixed order.

1. One scan makes each set and its signature. Equal sets are one node of the graph, however many
   documents have them.
2. *Candidates.* Every set lists its first n - T + k shingles in hash order, k about n / 8. The
   sets that list a shingle are counted over all documents. A set can have a partner only if enough of
   its listed shingles are listed elsewhere too; ordered by that count, its rarest
   ones must meet every partner, so frequent passages do not bring documents together.
   Sets that meet form coarse groups, by one edge per set and shingle, and a group is cut into bands of
   sizes that partners can have.
3. *Search.* A coarse group, or each pair of blocks of a large one, is searched by DivideSkip:
   the short inverted lists of a set are merged and counted, the L longest are only probed
   for those that reached T - L. Pairs that earlier links already connect are not checked
   again. Every check is of the whole sets.
4. Links within a block pair form a forest; components of all forests are the classes.

No list of pairs is ever made: rows sent are one per set and listed shingle, one per set and
block pair, one per tree edge. All comparisons of sets are of 64-bit shingle hashes; two shingles of one
pair of documents share a hash with probability about 2**-64.

Defined cases: a null or empty text, or one without words, has the empty set and links with
nothing; fewer words than a shingle has are one shingle; rows that repeat a doc_id are documents
of their own with the same id; rows with a null doc_id link like any other, and a null is the smallest id of
a class only when all its ids are null. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vantrail.llm.columns import hidden
from vantrail.llm.graph import components
from vantrail.llm.words import mixed, slices, split_words
from vantrail.session import spool

#: Shingles searched together in one task, about.
BLOCK = 400_000


@dataclass(frozen=True)
class Rule:
    """``size`` words a shingle; linked at a similarity of ``num / den`` or more."""

    size: int = 5
    num: int = 80
    den: int = 100

    def least(self, n):
        """Shingles that a partner of a set of ``n`` must share: ceil(n * num / den)."""
        return -(-n * self.num // self.den)

    def extra(self, n):
        return n // 8 + 1

    def listed(self, n):
        """Length of the list in hash order."""
        return np.minimum(n, n - self.least(n) + self.extra(n))

    def common(self, n):
        """Listed shingles that every partner has in its list too; a partner may be as small as least(n)."""
        return np.minimum(self.extra(self.least(n)), self.least(n))


def shingle_sets(column: pa.Array, rule: Rule) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = split_words(column, lower=True)
    grams, _ = words.grams(rule.size)
    out = []
    for a, b in words.bounds():
        if b - a >= rule.size:
            out.append(np.unique(grams[a : b - rule.size + 1]))
        else:
            out.append(np.array([words.whole(a, b)], np.uint64) if b > a else np.zeros(0, np.uint64))
    return out


def signature(ordered: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs; (0, 0) for the empty set."""
    if not len(ordered):
        return 0, 0
    with np.errstate(over="ignore"):
        a = mixed(ordered).sum(dtype=np.uint64)
        b = mixed(ordered ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(np.int64(a.astype(np.int64))), int(np.int64(b.astype(np.int64)))


def _signed(rule: Rule):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), rule)
                both = [signature(s) for s in sets]
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in both], pa.int64()), pa.array([b for _, b in both], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tag"), *columns], names=["doc_id", "tag", "n", "node", "check"])

    return scan


def _listed(rule: Rule):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s for s in shingle_sets(part.column("text"), rule) if len(s)]
                if not sets:
                    continue
                sizes = np.array([len(s) for s in sets])
                take = rule.listed(sizes)
                tokens = np.concatenate([s[:k] for s, k in zip(sets, take.tolist(), strict=True)])
                nodes = np.repeat(np.array([signature(s)[0] for s in sets], np.int64), take)
                n = np.repeat(sizes, take)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(nodes), pa.array(n, pa.int32())], names=["token", "node", "n"])

    return scan


def _sets(rule: Rule):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), rule)
                own = [signature(s)[0] == node for s, node in zip(sets, part.column("node").to_pylist(), strict=True)]
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("places"), shingles], names=["node", "places", "shingles"]).filter(pa.array(own))

    return scan


def _meeting(rule: Rule):
    """Per set: the listed shingles in whose list of sets it must be met by every partner."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("found")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            token, count = flat.field("token").to_numpy(), flat.field("lists").to_numpy()
            common = rule.common(batch.column("n").to_numpy().astype(np.int64))
            tokens, owners = [], []
            for i in range(batch.num_rows):
                a, b = ends[i], ends[i + 1]
                order = np.lexsort((token[a:b], count[a:b]))[: max(0, b - a - common[i] + 1)]
                tokens.append(token[a:b][order])
                owners.append(np.full(len(order), i))
            owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
            at = pa.array(owner.astype(np.int64))
            columns = [pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64)), batch.column("node").take(at), batch.column("n").take(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "node", "n"])

    return choose


class Forest:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)


def divide_skip(sets: list[np.ndarray], side: np.ndarray, rule: Rule, low: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Tree edges of the links between sets.

    ``side`` is 0 for all, or 0 and 1 for the blocks of a pair, where only links across are sought.
    Links between two sets that are ``low`` are left to the group of their own band.
    """
    low = np.zeros(len(sets), bool) if low is None else low.astype(bool)
    sizes = np.array([len(s) for s in sets])
    across = bool(side.any()) and not side.all()
    order = np.argsort(sizes, kind="stable")
    place = np.repeat(np.arange(len(order)), sizes[order])
    tokens = np.concatenate([sets[i] for i in order]) if len(order) else np.zeros(0, np.uint64)
    _, ids, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    lists = place[np.argsort(ids, kind="stable")]  # inverted lists, each in ascending order of size
    begins = np.cumsum(counts) - counts
    firsts = np.cumsum(sizes[order]) - sizes[order]
    forest, edges, roots = Forest(len(order)), [], np.arange(len(order))
    which, below = side[order], low[order]
    for q in range(len(order)):
        n = int(sizes[order[q]])
        if not n:
            continue
        need = int(rule.least(n))
        mine = ids[firsts[q] : firsts[q] + n]
        mine = mine[counts[mine] > 1]
        if len(mine) < need:
            continue
        mine = mine[np.argsort(counts[mine], kind="stable")]
        skip = min(need - 1, int(need / (0.01 * np.log2(max(2, counts[mine[-1]])) + 1)))
        short, long = mine[: len(mine) - skip], mine[len(mine) - skip :]
        merged = np.concatenate([lists[begins[t] : begins[t] + counts[t]] for t in short.tolist()])
        merged = merged[merged < q]
        if not len(merged):
            continue
        seen = np.bincount(merged, minlength=q)
        there = np.flatnonzero(seen >= max(1, need - skip))
        there = there[sizes[order[there]] >= need]
        if across:
            there = there[which[there] != which[q]]
        if below[q]:
            there = there[~below[there]]
        me = forest.root(q)
        there = np.array([c for c in there.tolist() if forest.root(c) != me], np.int64)
        if not len(there):
            continue
        if len(there) * 40 > counts[long].sum() // 50 + 40:  # many: count along the long lists instead of probing
            rest = np.concatenate([lists[begins[t] : begins[t] + counts[t]] for t in long.tolist()]) if skip else np.zeros(0, np.int64)
            overlap = (seen + np.bincount(rest[rest < q], minlength=q))[there]
        else:
            overlap = seen[there].copy()
            for k, c in enumerate(there.tolist()):
                other = ids[firsts[c] : firsts[c] + sizes[order[c]]]
                at = np.minimum(np.searchsorted(other, long), len(other) - 1)
                overlap[k] += int((other[at] == long).sum())
        union = n + sizes[order[there]] - overlap
        for c in there[rule.den * overlap >= rule.num * union].tolist():
            a, b = forest.root(q), forest.root(c)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                edges.append((int(order[q]), int(order[c])))
    return edges


def _searched(rule: Rule):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        nodes = group["node"].to_numpy(np.int64)
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        edges = divide_skip(sets, group["side"].to_numpy(), rule, group["low"].to_numpy())
        return pd.DataFrame({"a": nodes[[a for a, _ in edges]], "b": nodes[[b for _, b in edges]]}) if edges else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)

    return search


_PLACES = "array<struct<coarse:bigint,band:bigint,low:boolean,blocks:int>>"


def _bands(n: str, rule: Rule):
    """A set's band of sizes, and the next one, where it is low: partners differ by one band at most.

    Bands are a trifle wider than the rule asks, so that rounding cannot part two partners.
    """
    band = F.floor(F.log(n) / (math.log(rule.den / rule.num) * (1 + 1e-6)))
    return F.explode(F.array(F.struct(band.alias("band"), F.lit(False).alias("low")), F.struct((band + 1).alias("band"), F.lit(True).alias("low")))).alias("b")


def links(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Tree edges (a, b) between the nodes that links connect. ``nodes``: node, key of one document that has the set, n; ``docs``: key, text."""
    texts = docs.select("text").where(F.col("text").isNotNull())
    tokens = texts.mapInArrow(_listed(rule), "token long, node long, n int")
    shared = spool(tokens.groupBy("token").agg(F.count("*").alias("lists")).where("lists > 1"), "shingles")
    found = tokens.join(shared, "token").groupBy("node", "n").agg(F.collect_set(F.struct("token", "lists")).alias("found"))
    meet = spool(found.mapInArrow(_meeting(rule), "token long, node long, n int").select("token", "node", _bands("n", rule)).select("token", "node", "b.*"), "meetings")
    # Of the sets with one shingle and of neighbouring bands, one is the hub; at least one of them must not be low.
    hubs = meet.groupBy("token", "band").agg(F.min("node").alias("hub"), F.max("node").alias("other"), F.min("low").alias("low")).where("hub < other and not low")
    coarse = components(meet.join(hubs.select("token", "band", "hub"), ["token", "band"]).select(F.col("node").alias("a"), F.col("hub").alias("b")))

    member = nodes.join(coarse, "node").select("key", "node", "n", F.col("label").alias("coarse"), _bands("n", rule)).select("key", "node", "n", "coarse", "b.*")
    member = spool(member, "members")
    weights = member.groupBy("coarse", "band").agg(F.sum("n").alias("weight"), F.count("*").alias("sets"), F.min("low").alias("low")).where("sets > 1 and not low")
    sized = spool(weights.select("coarse", "band", "weight", F.ceil(F.col("weight") / BLOCK).cast("int").alias("blocks")), "groups")
    total = sized.agg(F.sum("weight").alias("n")).first()["n"] or 0
    groups = max(1, -(-total // BLOCK))
    placed = member.join(sized, ["coarse", "band"]).groupBy("key", "node").agg(F.collect_list(F.struct("coarse", "band", "low", "blocks")).alias("places"))
    # A document is found again by its key and, as a key may have several rows, by its set. Sets are large and are shuffled once, to their groups.
    sets = docs.join(placed, "key").select("node", "places", "text").mapInArrow(_sets(rule), f"node long, places {_PLACES}, shingles binary")
    one = sets.select("node", "shingles", F.explode("places").alias("p"))
    one = one.select("node", "shingles", "p.*").withColumn("key", F.xxhash64("coarse", "band")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own = F.array(F.struct(F.pmod("key", F.lit(groups)).alias("group"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda w: F.struct(F.col("key").alias("group"), (F.least(F.col("block"), w) + 1).alias("i"), (F.greatest(F.col("block"), w) + 1).alias("j"), (F.col("block") > w).cast("int").alias("side")),
    )
    spread = one.select("node", "low", "shingles", F.explode(F.when(F.col("blocks") == 1, own).otherwise(pairs)).alias("p")).select("node", "low", "shingles", "p.*")
    return spread.groupBy("group", "i", "j").applyInPandas(_searched(rule), "a long, b long")


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, tag (hash of the text), n_shingles, component_id and class (a hash, the same for all of a class) per row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = spool(slim.withColumn("tag", F.xxhash64("text")).mapInArrow(_signed(rule), "doc_id long, tag long, n long, node long, check long"), "signed")
    # The key of a document is its id, or the hash of its text where that is null; equal texts without id count once.
    key = F.coalesce("doc_id", "tag")
    nodes = signed.where("n > 0").groupBy("node", "check").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull(), key.alias("key"))).alias("k"))
    nodes = nodes.select("node", "check", "doc_id", "n", "k.key")
    named = slim.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("key"), "text")
    nameless = slim.where(F.col("doc_id").isNull()).groupBy("text").agg(F.lit(1)).select(F.xxhash64("text").alias("key"), "text")
    edges = spool(links(named.unionByName(nameless), nodes.select("node", "key", "n"), rule), "links")
    labels = components(edges)
    least = nodes.join(labels, "node").groupBy("label").agg(F.min("doc_id").alias("least"))
    joined = labels.join(least, "label").select("node", "label", F.col("least").alias("linked"))
    component = F.when(F.col("label").isNotNull(), F.col("linked")).otherwise(F.col("doc_id"))
    named = nodes.join(joined, "node", "left").select("node", "check", F.coalesce("label", "node").alias("class"), component.alias("component"))
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    return signed.join(named, ["node", "check"], "left").select("doc_id", "tag", F.col("n").alias("n_shingles"), component, "class")


def one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id, and of rows that share it the smallest hash of the text.

    Rows without words all stay; rows equal in doc_id and text stay or go together.
    """
    found = spool(classes(docs, rule), "classes")
    id_, tag_ = hidden("_id", docs), hidden("_tag", docs)
    first = found.where("n_shingles > 0").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "tag")).alias("f")).select("f.doc_id", "f.tag")
    stays = first.unionByName(found.where("n_shingles = 0").select("doc_id", "tag").distinct()).select(F.col("doc_id").alias(id_), F.col("tag").alias(tag_))
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(stays, docs["doc_id"].eqNullSafe(F.col(id_)) & (tag == F.col(tag_)), "left_semi")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under 3-word shingles and a similarity of 0.9."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classes(docs, Rule(3, 90, 100)).select("doc_id", "n_shingles", "component_id")
