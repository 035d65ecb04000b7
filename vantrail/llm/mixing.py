"""Mix sources to target weights by Poisson replication.

Every document gets a number of copies drawn from a Poisson distribution whose mean is
the repetition rate of its source: the target share of the source times all characters,
divided by the characters the source has. The draw inverts the distribution at a
uniform number hashed from the seed and the doc_id, so it is the same in every
retry and on every cluster. A rate beyond ``MOST_REPEATS`` is drawn as a sum of independent Poisson
numbers of equal means, which is Poisson of the whole rate. Copies are then dealt to random partitions and put in random order there.

All is built-in Spark SQL. Characters are summed map-side, the table of rates has one
row per named target, and copies are made row by row, so one source holding a
third of all rows needs no special care.

Defined cases: a null source is matched by a target named None; a source without a target has
rate 0; a null text counts as empty; an empty document is drawn like any other; when
all documents of a source are empty, its rate is 1; equal rows with equal doc_id draw the same number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vantrail.llm.columns import hidden

#: The list of targets is a setting made by a person; it travels to every task.
MOST_TARGETS = 10_000
SEED = 17
#: Largest mean of one draw; a larger rate is drawn in several parts.
MOST_REPEATS = 64.0
#: Terms of the inverted distribution. At a mean of 64 the rest has a probability below 2**-60.
TERMS = 160


def uniform(key: Column, seed: int, part: Column | None = None) -> Column:
    """A number in (0, 1) from the SHA-256 of seed and key: 52 bits, and the middle of its cell. Parts after part 0 have seeds of their own."""
    named = F.lit(str(seed)) if part is None else F.when(part == 0, str(seed)).otherwise(F.concat_ws(".", F.lit(str(seed)), part.cast("string")))
    digest = F.sha2(F.concat_ws(":", named, F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def poisson_terms(mean: Column) -> Column:
    """The distribution function at 0, 1, 2, ... by the recurrence of its terms."""
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("all"))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] * mean / j.cast("double")
        total = acc["sum"] + term
        return F.struct(term.alias("term"), total.alias("sum"), F.concat(acc["all"], F.array(total)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["all"]


def rates(docs: DataFrame, targets: Mapping[str | None, float] | None) -> DataFrame:
    """source, rate. ``targets`` are weights of sources; None: the same weight for each source there is."""
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit(""))).cast("long")).alias("chars"))
    if targets is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        if not targets or len(targets) > MOST_TARGETS or any(w < 0 for w in targets.values()):
            raise ValueError(f"1 to {MOST_TARGETS} targets with weights of 0 or more are needed")
        table = docs.sparkSession.createDataFrame([(k, float(w)) for k, w in targets.items()], "_named string, weight double")
        weighted = sizes.join(table, F.col("source").eqNullSafe(F.col("_named"))).drop("_named")
    everything = Window.partitionBy(F.lit(0))  # one row per source
    share = F.col("weight") / F.sum("weight").over(everything)
    rate = F.when(F.col("chars") == 0, 1.0).otherwise(share * F.sum("chars").over(everything) / F.col("chars"))
    return weighted.select("source", rate.alias("rate"))


def mix(docs: DataFrame, targets: Mapping[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``_copy`` (1, 2, ...), one row per drawn copy, in global random order.

    Extra columns are carried along, whatever their names; one named ``_copy`` is replaced.
    """
    docs = docs.drop("_copy")
    source, parts, terms, u, n, place = (hidden(x, docs) for x in ("_source", "_parts", "_terms", "_u", "_n", "_place"))
    rated = rates(docs.select("source", "text"), targets).withColumn(parts, F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_REPEATS).cast("int")))
    per_source = rated.select(F.col("source").alias(source), parts, poisson_terms(F.col("rate") / F.col(parts)).alias(terms))
    drawn = docs.join(per_source, docs["source"].eqNullSafe(per_source[source]), "inner")
    draws = F.transform(F.sequence(F.lit(0), F.col(parts) - 1), lambda part: uniform(F.col("doc_id"), seed, part))
    copies = F.aggregate(F.col(u), F.lit(0), lambda total, x: total + F.size(F.filter(F.col(terms), lambda c: c < x)))
    counted = drawn.withColumn(u, draws).withColumn(n, copies).where(F.col(n) > 0)
    several = counted.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias("_copy"))
    placed = several.withColumn(place, F.xxhash64(F.col("doc_id"), F.col("_copy"), F.lit(seed)))
    return placed.repartition(place).sortWithinPartitions(place).drop(place)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy that the mixture to equal weights of all sources keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", F.col("_copy").alias("copy"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


#: The same draw in SQL. The terms are summed in the same order.
OP9_SQL = f"""
WITH sizes AS (SELECT source, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY source),
whole AS (SELECT source, (CASE WHEN chars = 0 THEN 1.0 ELSE 1.0 / count(*) OVER () * sum(chars) OVER () / chars END)::DOUBLE AS rate FROM sizes),
rates AS (SELECT source, rate / parts AS rate, parts FROM (SELECT *, greatest(1, ceil(rate / {MOST_REPEATS}))::INTEGER AS parts FROM whole)),
RECURSIVE_terms AS (
  SELECT source, j, sum(exp(-rate + j * ln(rate) - lgamma(j + 1))) OVER (PARTITION BY source ORDER BY j) AS c
  FROM rates, range(0, {TERMS + 1}) t(j)
),
drawn AS (
  SELECT d.row, d.doc_id, d.source, sha256(coalesce(d.text, '')) AS text_sha256,
         (('0x' || substr(sha256('{SEED}' || CASE WHEN part = 0 THEN '' ELSE '.' || part END || ':' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
  FROM (SELECT d.*, unnest(range(0, r.parts)) AS part FROM (SELECT *, row_number() OVER () AS row FROM documents) d JOIN rates r ON r.source IS NOT DISTINCT FROM d.source) d
),
parts AS (SELECT d.*, (SELECT count(*) FROM RECURSIVE_terms t WHERE t.source IS NOT DISTINCT FROM d.source AND t.c < d.u) AS n FROM drawn d),
counts AS (SELECT row, doc_id, source, text_sha256, sum(n)::BIGINT AS n FROM parts GROUP BY ALL)
SELECT doc_id, source, copy::INTEGER AS copy, text_sha256 FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counts)
"""
