"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. One scan writes a slim table: doc_id, 64-bit fingerprint and SHA-256 of the text,
   and the number of the scan's partition, its *block*.
2. Every block sorts its distinct fingerprints, cuts them by owner (an owner holds a range of
   the fingerprints) and sends one Golomb-Rice coded message to each: near 64 less
   log2(fingerprints in the message) bits for a text of any length.
3. An owner decodes its messages and answers each with a bitmap: which of the sent
   fingerprints some other block has too. The block adds those that it has twice itself.
4. Only suspects go on: their texts are shuffled by fingerprint and grouped by all their bytes.

A text that a third of all rows have is one fingerprint a block in the exchange, and one
row a task in the grouping by bytes, because the grouping combines map-side. The rows of a
group are found again by a join that Spark may split.

Suspects are marked in the scan of the texts by a bitmap of fixed size (``FILTER_BITS``). When
it is full it lets more texts through; the join by fingerprint behind it is exact.

Defined cases: null counts as the empty text; of equal texts the largest doc_id stays, a null
doc_id counts as smaller than any; of rows that share text and doc_id one has
``kept``; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vantrail.llm import golomb
from vantrail.llm.columns import hidden
from vantrail.session import spool

#: Fingerprints of one owner, about: the number of owners follows the number of rows.
OWNER_ROWS = 250_000
#: Places of the filter; 2**25 bits are 1,024 rows of 4 KB, whatever the input.
FILTER_BITS = 1 << 25
_CHUNK = 32_768  # bits in one row of bitmap_construct_agg


def slim_table(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.xxhash64(text).alias("print"),
        F.sha2(text, 256).alias("text_sha256"),
        F.spark_partition_id().alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _messages(owners: int):
    def send(block: pd.DataFrame) -> pd.DataFrame:
        prints = np.unique(block["print"].to_numpy(np.int64).view(np.uint64))
        owner = (prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
        cuts = np.searchsorted(owner, np.arange(owners + 1))
        sent = [(o, int(block["block"].iloc[0]), golomb.encode(prints[a:b])) for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pd.DataFrame(sent, columns=["owner", "block", "message"])

    return send


def answer(messages: pd.DataFrame) -> pd.DataFrame:
    """A bitmap for each message of one owner: the fingerprints that came from several blocks."""
    lists = [golomb.decode(m) for m in messages["message"]]
    every = np.concatenate(lists)
    ordered, counts = np.unique(every, return_counts=True)
    shared = ordered[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared)).tobytes() for x in lists]
    return pd.DataFrame({"owner": messages["owner"], "block": messages["block"], "bitmap": bitmaps})


def _suspects(owners: int):
    def mark(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        prints, counts = np.unique(block["print"].to_numpy(np.int64).view(np.uint64), return_counts=True)
        marked = counts > 1
        owner = (prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
        for o, bitmap in zip(answers["owner"], answers["bitmap"], strict=True):
            a, b = np.searchsorted(owner, [o, o + 1])
            marked[a:b] |= np.unpackbits(np.frombuffer(bitmap, np.uint8))[: b - a].astype(bool)
        return pd.DataFrame({"print": prints[marked].view(np.int64)})

    return mark


def suspects(slim: DataFrame, rows: int) -> DataFrame:
    """Distinct fingerprints that more than one row has, by messages to owners and their answers."""
    owners = max(1, -(-rows // OWNER_ROWS))
    blocks = slim.select("block", "print")
    messages = blocks.groupBy("block").applyInPandas(_messages(owners), "owner int, block int, message binary")
    answers = messages.groupBy("owner").applyInPandas(answer, "owner int, block int, bitmap binary")
    marked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_suspects(owners), "print long")
    return spool(marked.distinct(), "suspects")


def _bit(fingerprint: Column) -> Column:
    return F.pmod(fingerprint, F.lit(FILTER_BITS))


def passing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with ``print``) whose fingerprint may be in ``found``.

    The filter is broadcast: its size is fixed by FILTER_BITS.
    """
    place = _bit(F.col("print"))
    bits = found.select((place / _CHUNK).cast("int").alias("_chunk"), (place % _CHUNK).alias("_place"))
    filled = bits.groupBy("_chunk").agg(F.expr("bitmap_construct_agg(_place)").alias("_bits"))
    inside = (F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))"))) != 0
    probed = docs.withColumn("_chunk", (place / _CHUNK).cast("int")).withColumn("_at", place % _CHUNK)
    return probed.join(F.broadcast(filled), "_chunk").where(inside).select(docs.columns)


def groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_sha256, keep_id, group_size, kept and ``row``."""
    slim = spool(slim_table(docs), "slim")
    found = suspects(slim, slim.count())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("print", F.xxhash64("text"))
    suspected = passing(texts, found).join(found, "print", "left_semi")
    equal = suspected.groupBy("print", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    equal = equal.where("group_size > 1").select("keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"))
    named = slim.join(equal, "text_sha256", "left").select(
        "row",
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
    )
    # Only rows that could stay are numbered, so a group of any size sends its repeats of one doc_id.
    stays = named.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("doc_id", "text_sha256").agg(F.min("row").alias("row"))
    stays = stays.select(F.col("row"), F.lit(True).alias("_stays"))
    return named.join(stays, "row", "left").withColumn("kept", F.coalesce("_stays", F.lit(False))).drop("_stays")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each set of equal texts; all columns stay.

    The rows that go are named by doc_id and text; of rows that also share the doc_id, one stays. Extra columns may have any names.
    """
    marked = groups(docs.select("doc_id", "text"))
    id_, sha, kept, copies, n = (hidden(x, docs) for x in ("_id", "_sha", "_kept", "_copies", "_n"))
    out = marked.where((F.col("group_size") > 1)).select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha), F.col("kept").alias(kept))
    fate = out.groupBy(id_, sha).agg(F.max(kept).alias(kept), F.count("*").alias(copies))
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    joined = docs.join(fate, docs["doc_id"].eqNullSafe(F.col(id_)) & (key == F.col(sha)), "left")
    once = joined.where(F.coalesce(kept, F.lit(True)))
    several = Window.partitionBy("doc_id", sha).orderBy(F.lit(0))
    single = once.where(F.coalesce(copies, F.lit(1)) == 1).select(docs.columns)
    repeats = once.where(F.col(copies) > 1).withColumn(n, F.row_number().over(several)).where(F.col(n) == 1).select(docs.columns)
    return single.unionByName(repeats)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fate of every document under exact deduplication."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
