"""Order-independent document fingerprints that can be updated paragraph by paragraph.

A document is a multiset of paragraphs. A paragraph ends at a line break; a line is
cut after ``.``, ``!`` or ``?`` before a space and after every ``PART_WORDS`` words, so that
short texts on one line have parts too. Every paragraph is hashed to a wide vector, and the fingerprint is
the sum of the vectors, each place modulo a power of two:

* the number of paragraphs;
* ``EQUAL`` places of 64 bits, modulo 2**64: two multisets that differ agree in all of
  them with probability about 2**-256. They decide equality.
* ``2 * LANES * SIGNS`` places of 32 bits, modulo 2**32, two in a long. A paragraph adds 0 or 1
  to each, by the bits of ``SIGNS`` of its hashes. Twice a place less the number of paragraphs is a sum of random signs, so the mean
  square of the difference of two fingerprints estimates how many paragraphs the two
  documents do not share. They give the likeness. For u of n + m paragraphs not shared, the estimate has a standard
  deviation of about u / (n + m) * sqrt(2 / 256), 0.09 at most.

Sums do not depend on order, so paragraphs can be added or taken away without
the rest of the document (``combined``). Everything is built-in Spark SQL.

Defined cases: a null text is an empty text; an empty text has no paragraphs and the
fingerprint of zeros; spaces around a paragraph do not count and paragraphs
without any other character are left out. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vantrail.functions.columns import computed_once
from vantrail.session import spool

EQUAL = 4
#: Longs of the likeness part a hash; each holds two 32-bit places. One hash has bits for 32.
LANES = 32
#: Hashes whose bits are signs: those of the equality part, so that none is computed for the likeness alone.
SIGNS = EQUAL
_LOW = 0xFFFFFFFF
_EIGHT = 0x0101010101010101
_BYTES = 0x000000FF000000FF
#: Hashes whose bits are counted in eight bits before the counters are widened: the uppermost counter must not reach the sign.
BLOCK = 127
PART_WORDS = 8


def paragraphs(text: Column) -> Column:
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=[.!?])\x20", "\n")
    lines = F.regexp_replace(lines, rf"((?:[^\x20\n]+\x20+){{{PART_WORDS}}})", "$1\n")
    parts = F.transform(F.split(lines, "\n"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def _high(x: Column) -> Column:
    return F.shiftrightunsigned(x, 32)


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_LOW))


def _wide(high: Column, low: Column) -> Column:
    """high * 2**32 + low modulo 2**64, by shifts, which do not overflow."""
    return F.shiftleft(high + F.shiftright(low, 32), 32).bitwiseOR(_low(low))


def _total(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + of(x))


def with_sums(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Adds the packed form of a fingerprint per text: ``texts`` maps the new column to the text column.

    It is what is stored and sent: a quarter of the vector, for a text of up to BLOCK paragraphs.
    """
    hashed = df.select("*", *(
        F.transform(paragraphs(F.col(text)), lambda p: F.array(*(F.xxhash64(p, F.lit(seed)) for seed in range(EQUAL)))).alias(f"_hashed_{name}")
        for name, text in texts.items()
    ))
    sums = {}
    for name in texts:
        h = F.col(f"_hashed_{name}")
        equal = [_wide(_total(h, lambda x, i=i: _high(x[i])), _total(h, lambda x, i=i: _low(x[i]))) for i in range(EQUAL)]
        sums[name] = F.struct(F.size(h).cast("long").alias("n"), F.array(*equal).alias("equal"), _packed(h).alias("packed"))
    return computed_once(hashed, **sums).select(*df.columns, *texts)


def vector_of(sums: Column) -> Column:
    """The vector of longs of a packed fingerprint."""
    return F.concat(F.array(sums["n"]), sums["equal"], _lanes(sums["packed"]))


def with_fingerprints(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Adds a vector of longs per text: ``texts`` maps the new column to the text column."""
    summed = with_sums(df, {f"_sums_{name}": text for name, text in texts.items()})
    return summed.select(*df.columns, *(vector_of(F.col(f"_sums_{name}")).alias(name) for name in texts))


def _packed(hashes: Column) -> Column:
    """Per block of hashes how often each bit is set, eight counters of eight bits in a long.

    Long k of a hash counts its bits k, k + 8, ...; no block has more hashes than a counter can hold.
    """
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / BLOCK).cast("int")), lambda b: F.slice(hashes, b * BLOCK + 1, BLOCK))
    counted = [lambda x, i=i, k=k: F.shiftrightunsigned(x[i], k).bitwiseAND(F.lit(_EIGHT)) for i in range(SIGNS) for k in range(8)]
    return F.when(F.size(hashes) > 0, F.transform(blocks, lambda block: F.array(*(_total(block, bit) for bit in counted)))).otherwise(F.array().cast("array<array<bigint>>"))


def _lanes(packed: Column) -> Column:
    """The counters of all blocks, added up in two places of 32 bits: lane k of a hash counts its bits k and k + 32."""
    at = [(8 * i + k % 8, 8 * (k // 8)) for i in range(SIGNS) for k in range(LANES)]
    return F.array(*(_total(packed, lambda p, i=i, by=by: F.shiftrightunsigned(p[i], by).bitwiseAND(F.lit(_BYTES))) for i, by in at))


def as_text(vector: Column) -> Column:
    """The whole vector as lowercase hex, 16 digits a long."""
    return F.concat_ws("", F.transform(vector, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))))


def combined(vector: Column, other: Column, take_away: bool = False) -> Column:
    """The fingerprint after the paragraphs of ``other`` are added or taken away."""
    sign = F.lit(-1 if take_away else 1).cast("long")

    def lanes(a: Column, b: Column) -> Column:
        return F.shiftleft(_low(_high(a) + _high(b) * sign), 32).bitwiseOR(_low(_low(a) + _low(b) * sign))

    def wide(a: Column, b: Column) -> Column:
        return _wide(_high(a) + _high(b) * sign, _low(a) + _low(b) * sign)

    pairs = F.transform(F.arrays_zip(vector.alias("a"), other.alias("b")), lambda p, i: F.when(i <= EQUAL, wide(p["a"], p["b"])).otherwise(lanes(p["a"], p["b"])))
    return pairs


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else 1 less the estimated share of paragraphs that are not common, at least 0."""
    n, m = a[0], b[0]
    squared = lambda x: (x * x).cast("double")
    per_pair = F.zip_with(
        F.slice(a, EQUAL + 2, LANES * SIGNS),
        F.slice(b, EQUAL + 2, LANES * SIGNS),
        lambda x, y: squared(2 * (_high(x) - _high(y)) - (n - m)) + squared(2 * (_low(x) - _low(y)) - (n - m)),
    )
    differ = F.aggregate(per_pair, F.lit(0.0), lambda s, x: s + x) / F.lit(2.0 * LANES * SIGNS)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - differ / F.greatest(n + m, F.lit(1))))


def following(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next larger doc_id; after the largest comes the smallest.

    Ids alone are sorted. Each range of ids is one window, and only the first id of each
    range, one row per partition, meets in a single task.
    """
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    ranged = spool(ids.repartitionByRange("doc_id").select("doc_id", F.spark_partition_id().alias("range")), "id-ranges")
    heads = ranged.groupBy("range").agg(F.min("doc_id").alias("head"))
    all_heads = Window.partitionBy(F.lit(0))
    border = F.coalesce(F.lead("head").over(all_heads.orderBy("head")), F.min("head").over(all_heads))
    borders = heads.select("range", border.alias("border"))
    within = F.lead("doc_id").over(Window.partitionBy("range").orderBy("doc_id"))
    return ranged.withColumn("next_id", within).join(borders, "range").select("doc_id", F.coalesce("next_id", "border").alias("next_id"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, text, edited: the last half of each text replaced by the first half of the next.

    Only as many characters of the next text travel as the edit can need. Rows
    that repeat a doc_id share their successor; as the next document counts the row
    with the smallest text. A null doc_id has no successor: its last half just goes.
    """
    half = (F.length("text") / 2).cast("int")
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition("doc_id")
    needs = docs.groupBy("doc_id").agg(F.max(F.coalesce(half, F.lit(0))).alias("needs"))
    asked = following(docs).join(needs, "doc_id").select(F.col("doc_id").alias("asker"), F.col("next_id").alias("doc_id"), "needs")
    # Both joins on doc_id read the one exchange of ``texts``; rows without an id are apart so that its plan is the same in both.
    firsts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    heads = firsts.join(asked, "doc_id").select(F.col("asker").alias("doc_id"), F.col("doc_id").alias("next_id"), F.substr("text", F.lit(1), F.col("needs")).alias("head"))
    kept = F.substr("text", F.lit(1), F.length("text") - half)
    edited = F.concat(kept, F.coalesce(F.substr("head", F.lit(1), half), F.lit("")))
    named = texts.join(heads, "doc_id", "left").select("doc_id", "next_id", "text", edited.alias("edited"))
    nameless = docs.where(F.col("doc_id").isNull()).select("doc_id", F.col("doc_id").alias("next_id"), F.coalesce("text", F.lit("")).alias("text"))
    return named.unionByName(nameless.withColumn("edited", kept))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with both fingerprints and both likenesses."""
    pairs = with_sums(edited_texts(docs), {"own": "text", "changed": "edited"})
    rows = spool(pairs.select("doc_id", "next_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "own", "changed"), "multiset")
    nexts = rows.groupBy(F.col("doc_id").alias("next_id")).agg(F.min("own").alias("following"))
    joined = rows.join(nexts, "next_id", "left")
    wide = computed_once(joined, vector=vector_of(F.col("own")), edited_vector=vector_of(F.col("changed")), next_vector=vector_of(F.col("following")))
    return wide.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        F.coalesce(likeness(F.col("vector"), F.col("next_vector")), F.lit(0.0)).alias("near_next"),
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return document_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
