"""Removal of word sequences that an earlier document has too: equal windows grouped by hash.

A *window* is ``WINDOW`` words in a row. A window goes when its words also start in a document
with a smaller doc_id; a word goes when such a window covers it.

1. *Which suffixes can repeat.* The anchor of a window is the least of its ``GRAM``-word hashes. Equal
   windows have equal anchors, and about 6 windows in a row share one, so anchors are a sixth
   of the suffixes. The documents of every anchor are counted; anchors of one document are dropped.
2. *Groups.* Windows in a row with one anchor are a run: it holds a 64-bit hash of each, made from the 64-bit
   hashes of its words. Runs go to groups by anchor. Groups are of about ``GROUP_RUNS`` runs: many
   rare anchors share a group, and an anchor with more runs is split by document.
3. *Equal windows.* In a group the windows are sorted by their hashes; two different windows of one anchor share
   one with a probability of about 2**-64, as everywhere here.
   Of equal windows every one goes, but for those of the smallest document. Of a split anchor, each part names the
   smallest document of its windows, and those few meet in a second round of the same kind.
4. *Removal.* Marked windows go back to their document, and its words are cut.

The groups are keyed by the anchor inside the first WINDOW words of a suffix instead of by its
first words: that is a sixth of the rows, and a frequent beginning does not make a large group.

This stands in for suffix trees: what is removed depends on nodes of depth WINDOW alone, which equal windows are. No suffixes
are ordered, there are no nodes of other depths, and maximal repeats are not made.

Defined cases: a null text has no words; rows that repeat a doc_id are one document for the order and
each keeps its own words; a row without doc_id neither removes words nor loses any; an empty
table gives no rows; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vantrail.llm.words import Words, slices, split_words
from vantrail.session import spool

WINDOW = 13
GRAM = 4
GROUP_RUNS = 40_000


def anchors_of(words: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of the window at each word, and whether the window lies in one text."""
    grams, _ = words.grams(GRAM)
    n, size = len(grams), window - GRAM + 1
    least, width = grams, 1
    while width < size:  # minimum over 2, 4, 8, ... grams
        step = min(width, size - width)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        width += step
    out = np.zeros(n, np.uint64)
    out[: len(least)] = least
    whole = np.arange(n) + window <= np.repeat(words.first[1:], words.counts())
    return out, whole


def _runs(anchors: np.ndarray, keep: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of kept windows with one anchor in one text."""
    at = np.flatnonzero(keep)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (anchors[at[1:]] != anchors[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at)))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = split_words(part.column("text"))
            anchors, whole = anchors_of(words)
            doc = np.repeat(np.arange(part.num_rows), words.counts())
            starts, _ = _runs(anchors, whole, doc)
            anchor, owner = anchors[starts], doc[starts]
            order = np.lexsort((anchor, owner))
            anchor, owner = anchor[order], owner[order]
            once = np.ones(len(order), bool)
            once[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)[owner[once]]
            yield pa.RecordBatch.from_arrays([pa.array(anchor[once].view(np.int64)), pa.array(ids, pa.int64())], names=["anchor", "doc_id"])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "parts", "doc_id", "tag", "start", "words"]
    for batch in batches:
        for part in slices(batch, "text"):
            words = split_words(part.column("text"))
            anchors, whole = anchors_of(words)
            doc = np.repeat(np.arange(part.num_rows), words.counts())
            keep, split = np.zeros(len(anchors), bool), np.ones(len(anchors), np.int32)
            lists = part.column("hits")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            hit, into = flat.field("anchor").to_numpy().view(np.uint64), flat.field("parts").to_numpy()
            for d, (a, b) in enumerate(words.bounds()):
                mine, where = np.unique(hit[ends[d] : ends[d + 1]], return_index=True)
                if not len(mine) or a == b:
                    continue
                k = np.minimum(np.searchsorted(mine, anchors[a:b]), len(mine) - 1)
                keep[a:b] = mine[k] == anchors[a:b]
                split[a:b] = into[ends[d] : ends[d + 1]][where][k]
            starts, lengths = _runs(anchors, keep & whole, doc)
            hashes = words.grams(WINDOW)[0].astype("<u8").tobytes()
            rows = [hashes[8 * a : 8 * (a + n)] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
            owner = doc[starts]
            columns = [
                pa.array(anchors[starts].view(np.int64)),
                pa.array(split[starts]),
                part.column("doc_id").take(pa.array(owner)),
                part.column("tag").take(pa.array(owner)),
                pa.array((starts - words.first[owner]).astype(np.int32)),
                pa.array(rows, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


_MARKS = "doc_id long, tag long, start int, length int, anchor long, words binary"


def repeats_in(runs: pd.DataFrame) -> pd.DataFrame:
    """Windows below the deep nodes of one group; with ``words``: the smallest document of a node of a split anchor."""
    counts = runs["words"].str.len().to_numpy(np.int64) // 8
    key = np.frombuffer(b"".join(runs["words"]), "<u8")
    row = np.repeat(np.arange(len(runs)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.argsort(key, kind="stable")
    node = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])]) if len(order) else order
    doc = runs["doc_id"].to_numpy(np.int64)[row][order]
    firsts = np.flatnonzero(np.diff(node, prepend=-1))
    least = np.minimum.reduceat(doc, firsts)[node] if len(order) else doc
    goes, begin = np.zeros(len(row), bool), np.zeros(len(row), bool)
    goes[order] = doc > least
    # marked windows in a row of one run are one mark
    begin[goes] = True
    begin[1:] &= ~(goes[:-1] & (row[1:] == row[:-1]))
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(goes & ~np.concatenate([(goes[1:] & (row[1:] == row[:-1])), [False]])) if len(row) else starts
    r = row[starts]
    marks = pd.DataFrame(
        {
            "doc_id": runs["doc_id"].to_numpy()[r],
            "tag": runs["tag"].to_numpy()[r],
            "start": (runs["start"].to_numpy()[r] + within[starts]).astype(np.int32),
            "length": (ends - starts + WINDOW).astype(np.int32),
            "anchor": np.zeros(len(r), np.int64),
            "words": [None] * len(r),
        }
    )
    split = runs["parts"].to_numpy()[row] > 1
    if not split.any():
        return marks
    leads = np.flatnonzero(split & ~goes)
    lead = pd.DataFrame(
        {
            "doc_id": runs["doc_id"].to_numpy()[row[leads]],
            "tag": runs["tag"].to_numpy()[row[leads]],
            "start": (runs["start"].to_numpy()[row[leads]] + within[leads]).astype(np.int32),
            "length": np.zeros(len(leads), np.int32),
            "anchor": runs["anchor"].to_numpy()[row[leads]],
            "words": [key[i].tobytes() for i in leads],
        }
    )
    return pd.concat([marks, lead])


def marks(texts: DataFrame, scan: DataFrame) -> DataFrame:
    """doc_id, tag, start, length of the words to cut. ``scan`` has the same documents as ``texts``."""
    anchors = scan.select("doc_id", "text").mapInArrow(_anchor_rows, "anchor long, doc_id long")
    counted = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    shared = spool(counted.select("anchor", F.ceil(F.col("n") / GROUP_RUNS).cast("int").alias("parts")), "anchors")
    hits = anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set(F.struct("anchor", "parts")).alias("hits"))
    hits = spool(hits, "hits")
    total = hits.agg(F.sum(F.size("hits")).alias("n")).first()["n"] or 0
    groups = max(1, -(-total // GROUP_RUNS))
    runs = texts.join(hits, "doc_id").mapInArrow(_run_rows, "anchor long, parts int, doc_id long, tag long, start int, words binary")
    bucket = F.pmod("anchor", F.lit(groups)).alias("bucket")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("part")
    found = runs.select("*", bucket, part).groupBy("bucket", "part").applyInPandas(repeats_in, _MARKS)
    # Marks pass through the second round in groups by document; the text they join is then exchanged once for all.
    again = F.when(F.col("words").isNull(), F.pmod(F.xxhash64("doc_id"), F.lit(groups))).otherwise(F.pmod("anchor", F.lit(groups)))
    return found.groupBy(again.alias("bucket")).applyInPandas(_second_round, "doc_id long, tag long, start int, length int")


def _second_round(rows: pd.DataFrame) -> pd.DataFrame:
    lead = rows["words"].notna()
    done = rows[~lead]
    if lead.any():
        done = pd.concat([done, repeats_in(rows[lead].assign(parts=1))])
    return done[["doc_id", "tag", "start", "length"]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = split_words(part.column("text"))
            data = words.data.tobytes()
            tags = part.column("tag").to_pylist()
            counts, gone, digests = words.counts(), [], []
            for d, ((a, b), found) in enumerate(zip(words.bounds(), part.column("marks").to_pylist(), strict=True)):
                stays = np.ones(b - a, bool)
                for m in found or ():
                    if m["tag"] == tags[d]:
                        stays[m["start"] : m["start"] + m["length"]] = False
                gone.append(int(b - a - stays.sum()))
                at = np.flatnonzero(stays) + a
                kept = b" ".join([data[i:j] for i, j in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)])
                digests.append((kept.decode(), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array([k for k, _ in digests], pa.string()), pa.array([h for _, h in digests])],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space), kept_sha256 per row of ``docs``."""
    named = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Both joins on doc_id read this one exchange of the texts.
    texts = named.withColumn("tag", F.xxhash64("text")).repartition("doc_id")
    found = marks(texts, named).groupBy("doc_id").agg(F.collect_list(F.struct("tag", "start", "length")).alias("marks"))
    nameless = docs.where(F.col("doc_id").isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    nameless = nameless.withColumn("tag", F.lit(0).cast("long")).withColumn("marks", F.lit(None).cast(found.schema["marks"].dataType))
    whole = texts.join(found, "doc_id", "left").unionByName(nameless)
    return whole.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when passages of earlier documents are taken out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).drop("kept")
