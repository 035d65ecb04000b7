"""Near duplicates by SuperMinHash signatures: banding, verification on full sets, union-find.

Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets of shingles; a class is what links
connect.

1. One scan makes each set, its 128-bit name and its *SuperMinHash* signature. Every element visits the slots in
   the order of a permutation of its own, and on its step j offers the slot j plus a fraction; a slot keeps its
   smallest offer. The ranks of one element are correlated (no two slots get the same step), so the signature
   estimates the similarity with less variance than independent permutations. An offer of step j cannot beat
   one below j, so an element stops once every slot of its set holds less (early stopping): a large set
   costs about one step per element. Equal sets are one *node*, however many documents have them.
2. *Banding.* ``ROWS`` slots in a row are a band; nodes that agree in one meet in a bucket. Two sets at the least
   similarity of 0.8 miss each other in all 32 bands with a probability of about 3e-6.
3. *Best partners.* In its buckets each node finds the partner whose signature agrees most; that one link is
   verified on the full sets. This joins groups of copies to what they were copied from: one row per node.
4. *The rest.* Buckets whose nodes are not yet in one component are searched whole: every pair whose
   signatures do not rule out a link (``LEAST_LIKENESS``, six standard deviations below 0.8) and that is not yet
   connected is verified on the full sets, in the bucket of its first common band. Large buckets are searched as
   pairs of blocks. Rows sent are one per node and bucket, never one per pair.
5. Both searches keep a union-find per task and return tree edges; components of all edges are the classes.

Defined cases: a null or empty text, or one without words, has the empty set and links with nothing; fewer
words than a shingle has are one shingle; rows that repeat a doc_id are documents of their own with the same
id; rows with a null doc_id link like any other, and the smallest id of a class is null only when all
its ids are; equal offers or partners are decided by the smaller hash; an empty table gives no rows;
columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vantrail.llm.exact import passing
from vantrail.llm.graph import components
from vantrail.llm.jaccard import Forest, Rule, shingle_sets, signature
from vantrail.llm.words import mixed, slices
from vantrail.session import spool

#: Slots of a signature, and slots of a band.
SLOTS, ROWS = 160, 5
#: Pairs whose signatures agree in less than this share of the slots cannot be 0.8 alike.
LEAST_LIKENESS = 0.6
#: Elements that visit slots together (memory: this many permutations of the slots).
CHUNK = 1 << 15
#: Nodes of a bucket that are compared with each other at once.
BLOCK = 512
#: Rows of one task of a search, about.
TASK_ROWS, TASK_BYTES = 20_000, 8 << 20
#: Leaves that are compared with one partner in one group; a partner with more is sent to several.
LEAVES = 256

_STEPS = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
_BAND = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_SLOT = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """The signatures of sets of 64-bit hashes, a row each; ``inf`` in the row of an empty set."""
    kept = np.full(len(sets) * slots, np.inf)
    table = kept.reshape(len(sets), slots)
    last = np.full(len(sets), slots - 1)  # the last step whose offers can still be kept
    sizes = np.array([len(s) for s in sets], np.int64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    for start in range(0, len(elements), CHUNK):
        x, owner = elements[start : start + CHUNK], owners[start : start + CHUNK]
        order = None
        for step in range(slots):
            going = last[owner] >= step
            if not going.all():
                x, owner = x[going], owner[going]
                order = order[going] if order is not None else None
            if not len(x):
                break
            draw = mixed(x + _STEPS[step])
            at = step + ((draw & np.uint64(0xFFFFFF)) * np.uint64(slots - step) >> np.uint64(24)).astype(np.int64)
            if order is None:
                slot = at
                if (last[owner] > 0).any():
                    order = np.empty((len(x), slots), np.uint8)
                    order[:] = np.arange(slots, dtype=np.uint8)
                    rows = np.arange(len(x))
                    order[rows, at] = 0
                    order[:, 0] = at
            else:
                rows = np.arange(len(x))
                slot = order[rows, at].astype(np.int64)
                order[rows, at] = order[:, step]
                order[:, step] = slot
            offer = step + (draw >> np.uint64(24)).astype(np.float64) * 2.0**-40
            key = owner * slots + slot
            better = offer < kept[key]
            np.minimum.at(kept, key[better], offer[better])
            touched = owner[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])]
            highest = table[touched].max(1)
            last[touched] = np.where(np.isinf(highest), slots - 1, np.minimum(highest, slots - 1)).astype(np.int64)
    return table


def bands(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """The bucket of each band; buckets of different bands are different."""
    bits = mixed(table.view(np.uint64)) * _SLOT[: table.shape[1]]
    sums = bits.reshape(len(table), -1, rows).sum(2, dtype=np.uint64)
    return mixed(sums ^ _BAND[: sums.shape[1]])


def short(table: np.ndarray) -> np.ndarray:
    """One byte of each slot."""
    return (mixed(table.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def likeness(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity from short signatures; two different slots agree once in 256."""
    return ((one == others).mean(1) - 1 / 256) / (1 - 1 / 256)


_SIGNED = "doc_id long, print long, n long, node long, check long, sig binary, bands array<long>"


def _signed(rule: Rule):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), rule)
                table = superminhash(sets)
                names = [signature(s) for s in sets]
                found = bands(table)
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * found.shape[1])
                columns = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in names], pa.int64()),
                    pa.array([b for _, b in names], pa.int64()),
                    pa.array([s.tobytes() for s in short(table)], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(found.ravel().view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("print"), *columns], names=["doc_id", "print", "n", "node", "check", "sig", "bands"])

    return scan


def _agreed(sig: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sig), np.uint8).reshape(len(sig), SLOTS)


def _best_partners(rows: pd.DataFrame) -> pd.DataFrame:
    """Of every node in the buckets of one task the partner that agrees most, if it may be alike."""
    rows = rows.sort_values(["bucket", "part", "node"], kind="stable")
    bucket, part, node = (rows[c].to_numpy() for c in ("bucket", "part", "node"))
    sig = _agreed(rows["sig"])
    cuts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1]), True])
    best, partner = np.full(len(rows), -1.0), np.zeros(len(rows), np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = sig[a:b]
        for i in range(b - a if b - a > 1 else 0):
            like = likeness(own[i], own)
            like[i] = -1
            j = int(like.argmax())
            best[a + i], partner[a + i] = like[j], node[a + j]
    keep = best >= LEAST_LIKENESS
    return pd.DataFrame({"node": node[keep], "partner": partner[keep], "like": best[keep]})


def _linked(a: np.ndarray, b: np.ndarray, rule: Rule) -> bool:
    least, most = sorted((len(a), len(b)))
    if rule.den * least < rule.num * most:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return rule.den * both >= rule.num * (least + most - both)


def _sets(texts: pd.Series, rule: Rule) -> list[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    return [s for part in slices(batch, "text") for s in shingle_sets(part.column("text"), rule)]


def _checked_partners(rule: Rule):
    """Links of leaves with the partner of their group, on the full sets."""

    def check(rows: pd.DataFrame) -> pd.DataFrame:
        sets = _sets(rows["text"], rule)
        place = {key: k for k, key in enumerate(zip(rows["center"], rows["salt"], rows["node"], strict=True))}
        edges = []
        for (center, salt, node), k in place.items():
            if node != center and (center, salt, center) in place and _linked(sets[k], sets[place[center, salt, center]], rule):
                edges.append((node, center))
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return check


def _candidates(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of one bucket, or of two of its blocks, that may be alike, are not connected and have no earlier common band."""
    sig, label, side = _agreed(rows["sig"]), rows["label"].to_numpy(), rows["side"].to_numpy()
    band = int(rows["band"].iloc[0])
    across = bool(side.any()) and not side.all()
    found, likes = [], []
    for i in range(len(rows) - 1):
        others = np.arange(i + 1, len(rows))
        others = others[label[others] != label[i]]
        if across:
            others = others[side[others] != side[i]]
        if not len(others):
            continue
        like = likeness(sig[i], sig[others])
        others, like = others[like >= LEAST_LIKENESS], like[like >= LEAST_LIKENESS]
        same = (sig[i] == sig[others]).reshape(len(others), SLOTS // ROWS, ROWS).all(2)
        first = same.argmax(1) == band
        found.append(np.stack([np.full(first.sum(), i), others[first]], 1))
        likes.append(like[first])
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    order = np.argsort(-np.concatenate(likes), kind="stable") if found else slice(None)
    return map(tuple, pairs[order].tolist())


def _waiting(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of the groups of one task that have a pair to be verified there."""
    out = []
    for _, own in rows.groupby(["bucket", "i", "j"], sort=False):
        own = own.sort_values("node", kind="stable")
        there = np.unique(np.array([x for pair in _candidates(own) for x in pair], np.int64))
        out.append(own.iloc[there])
    return pd.concat(out)[["bucket", "i", "j", "band", "side", "node", "label"]]


def _checked_rest(rule: Rule):
    def check(rows: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, own in rows.groupby(["bucket", "i", "j"], sort=False):
            own = own.sort_values("node", kind="stable")
            sets = _sets(own["text"], rule)
            labels, index = np.unique(own["label"].to_numpy(), return_inverse=True)
            node, forest = own["node"].to_numpy(), Forest(len(labels))
            for i, j in _candidates(own):
                a, b = forest.root(int(index[i])), forest.root(int(index[j]))
                if a != b and _linked(sets[i], sets[j], rule):
                    forest.up[max(a, b)] = min(a, b)
                    edges.append((int(node[i]), int(node[j])))
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return check


def _tasks(of: str | tuple, rows: int, size: int = TASK_ROWS):
    """A number of the task for the groups named by ``of``; groups stay whole."""
    return F.pmod(F.xxhash64(*([of] if isinstance(of, str) else of)), F.lit(max(1, -(-rows // size)))).alias("task")


class Texts:
    """Finds the texts of nodes again. Only rows of wanted documents are shuffled: a filter of fixed size marks them in the scan."""

    def __init__(self, keyed: DataFrame, nodes: DataFrame) -> None:
        self.keyed, self.nodes = keyed, nodes.select("node", "print")

    def of(self, wanted: DataFrame) -> DataFrame:
        """(node, text) of the distinct nodes of ``wanted``."""
        named = spool(wanted.select("node").distinct().join(self.nodes, "node"), "wanted")
        there = passing(self.keyed.select("print", "text"), named.select("print")).join(named, "print")
        # One row a node: rows that share id and text share the key too.
        return spool(there.groupBy("node").agg(F.first("text").alias("text")), "texts")


def best_links(meetings: DataFrame, nodes: DataFrame, texts: Texts, rule: Rule) -> DataFrame:
    """Verified edges of every node with its best partner. ``meetings``: bucket, members, node."""
    count = meetings.count()
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)).cast("int")
    sent = meetings.withColumn("part", part).withColumn("task", _tasks(("bucket", "part"), count)).join(nodes.select("node", "sig"), "node")
    near = sent.select("task", "bucket", "part", "node", "sig").groupBy("task").applyInPandas(_best_partners, "node long, partner long, like double")
    best = spool(near.groupBy("node").agg(F.max(F.struct("like", "partner")).alias("b")).select("node", F.col("b.partner").alias("center")), "partners")
    back = best.select(F.col("center").alias("node"), F.col("node").alias("center"))
    twice = best.join(back, ["node", "center"], "left_semi").where("node < center")  # a pair that chose each other is one edge
    edges = best.join(twice, ["node", "center"], "left_anti")
    leaves = edges.groupBy("center").agg(F.count("*").alias("leaves"))
    salted = edges.join(leaves, "center").withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("leaves") / LEAVES)).cast("int"))
    groups = salted.select("center", "salt", "node").unionByName(salted.select("center", "salt", F.col("center").alias("node")).distinct())
    groups = spool(groups, "stars")
    found = groups.join(texts.of(groups), "node")
    size = found.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    return found.withColumn("task", _tasks(("center", "salt"), size, TASK_BYTES)).groupBy("task").applyInPandas(_checked_partners(rule), "a long, b long")


def other_links(meetings: DataFrame, nodes: DataFrame, labels: DataFrame, texts: Texts, rule: Rule) -> DataFrame:
    """Verified edges between nodes that meet and are not connected by ``labels`` (node, label)."""
    known = meetings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed_up = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
    open_ = spool(known.join(mixed_up, "bucket"), "open").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda w: F.struct(F.least("block", w).alias("i"), F.greatest("block", w).alias("j"), (F.col("block") > w).cast("int").alias("side")),
    )
    spread = open_.withColumn("block", block).select("bucket", "band", "node", "label", F.explode(pairs).alias("p")).select("bucket", "band", "node", "label", "p.*")
    sent = spread.withColumn("task", _tasks(("bucket", "i", "j"), open_.count())).join(nodes.select("node", "sig"), "node")
    fields = "bucket long, i int, j int, band int, side int, node long, label long"
    waiting = spool(sent.groupBy("task").applyInPandas(_waiting, fields), "waiting")
    found = waiting.join(texts.of(waiting), "node").join(nodes.select("node", "sig"), "node")
    size = found.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    return found.withColumn("task", _tasks(("bucket", "i", "j"), size, TASK_BYTES)).groupBy("task").applyInPandas(_checked_rest(rule), "a long, b long")


def near_classes(docs: DataFrame, rule: Rule = Rule(2, 80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row of ``docs``. The bands fit a similarity of 0.8 or more."""
    if rule.num * 10 < rule.den * 8:
        raise ValueError("signatures and bands are made for a similarity of 0.8 or more")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = slim.withColumn("print", F.xxhash64("doc_id", "text"))
    signed = spool(keyed.mapInArrow(_signed(rule), _SIGNED), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print")).alias("f")
    nodes = signed.where("n > 0").groupBy("node", "check").agg(first, F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    nodes = spool(nodes.select("node", "check", "f.doc_id", "f.print", "sig", "bands"), "nodes")
    texts = Texts(keyed, nodes)
    keys = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = spool(keys.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "buckets")
    meetings = spool(keys.join(shared, "bucket"), "meetings")
    best = spool(best_links(meetings, nodes, texts, rule), "links")
    rest = spool(other_links(meetings, nodes, components(best), texts, rule), "links")
    labels = components(best.unionByName(rest))
    least = nodes.join(labels, "node").groupBy("label").agg(F.min("doc_id").alias("least"))
    linked = labels.join(least, "label").select("node", F.lit(True).alias("linked"), "least")
    named = nodes.select("node", "check", "doc_id").join(linked, "node", "left")
    named = named.select("node", "check", F.when(F.col("linked"), F.col("least")).otherwise(F.col("doc_id")).alias("component"))
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = signed.select("doc_id", "n", "node", "check").join(named, ["node", "check"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under 2-word shingles and a similarity of 0.8."""
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
