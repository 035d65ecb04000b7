"""Personal data: fixed patterns, and identifiers that contexts learnt from them give away.

Bootstrapping. The matches of the fixed patterns are seeds. A *slot* is a word with a digit or an
``@``; its *instance* is the word itself, its *patterns* are the word before it, the two words before it and the words on both
sides. Slots are edges of a graph of patterns and instances. In each round, a pattern's
confidence for a kind is the share that instances of this kind have of its slots, one per document and instance, that
speak for or against it: slots of another kind, and words that cannot be of this kind, speak against; unseen words
that can be are unlabelled. An instance's score is what its patterns make likely together. A pattern that is
confident, and was seen in enough documents, with enough different seeds that fill ``LEAST_SHARE`` of all its slots, marks the other
words in its slots; these are seeds of the next round. All documents count, and sums are built map-side, so a pattern or
word that a third of all documents have needs no special care.

Defined cases: a null or empty text has no spans; repeated rows are scanned each and count once
per doc_id as evidence; a word that a fixed pattern touches gets no second span; columns beyond
doc_id and text are not read. Time is linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vantrail.llm.secret_scan import digest, joined
from vantrail.llm.words import slices
from vantrail.session import spool

KINDS = ("email", "ip", "card", "phone")
NAMES = (*KINDS, "like_email", "like_ip", "like_card", "like_phone")
# Fixed values of the contract.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

ROUNDS = 3
#: A pattern speaks when this share of its slots is of one kind, in so many documents and with so many different seeds.
CONFIDENT, LEAST_DOCS, LEAST_SEEDS = 0.9, 5, 4
ACCEPTED = 0.9
#: Known instances must fill this share of a pattern's slots, or the unseen ones are no likely neighbours of theirs.
LEAST_SHARE = 1 / 3
#: Longer words stand in patterns as a hash.
LONG = 100
#: Digits that a discovered word must have, by kind; an address needs its @ instead.
LEAST_DIGITS = {1: 4, 2: 12, 3: 7}

_BASE, _PRIME = 1_000_003, (1 << 61) - 1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SLOT = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the longest local part before each @ and the longest domain behind it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by kind and start."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in (p.lstrip("0")[:4] or "0" for p in m[0].split(".")))]
    for kind, pattern, low, high in ((2, CARD, 13, 19), (3, PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = "".join(filter(str.isdigit, m[0]))
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return found


def slots(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """(start, end, kind or -1, instance, patterns) of words with a digit or @, and of the seeds as wholes."""
    out = []
    places = sorted((s, e, k) for s, k, e in spans)
    ends = -1
    merged = []
    for s, e, k in places:  # of spans that overlap, the first
        if s >= ends:
            merged.append((s, e, k))
            ends = e
    i = 0
    for m in _SLOT.finditer(text):
        while i < len(merged) and merged[i][1] <= m.start():
            i += 1
        if not (i < len(merged) and merged[i][0] < m.end()):
            merged_kind = -1
            out.append((m.start(), m.end(), merged_kind))
    out += merged
    result = []
    words = [m.span() for m in _WORD.finditer(text)] if out else []
    starts, stops = [a for a, _ in words], [b for _, b in words]
    sums: dict[int, list[int]] = {}

    def key(i: int, a: int, b: int) -> str:
        """The part from a to b of word i, in small letters; linear in the text also when many slots share a long word."""
        if b - a <= LONG:
            return text[a:b].lower()
        if i not in sums:
            total = [0]
            for c in text[starts[i] : stops[i]]:
                total.append((total[-1] * _BASE + ord(c.lower()[0])) % _PRIME)
            sums[i] = total
        first = starts[i]
        return f"#{b - a}:{(sums[i][b - first] - sums[i][a - first] * pow(_BASE, b - a, _PRIME)) % _PRIME}"

    for s, e, k in sorted(out):
        i, j = bisect_left(starts, s) - 1, bisect_right(stops, e)
        left = key(i, starts[i], min(stops[i], s)) if i >= 0 else "^"
        pair = f"{key(i - 1, *words[i - 1])} {left}" if i >= 1 else left
        right = key(j, max(starts[j], e), stops[j]) if j < len(words) else "$"
        result.append((s, e, k, text[s:e], [f"l {left}", f"b {pair}", f"s {left} {right}"]))
    return result


_FOUND = (
    "doc_id long, row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start:int,kind:int,end:int>>, "
    "slots array<struct<start:int,end:int,kind:int,instance:string,patterns:array<string>>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    triple = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    slot = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))
    names = ["doc_id", "row", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "slots"]
    for batch in batches:
        for part in slices(batch, "text"):
            spans = [base_spans(t or "") for t in part.column("text").to_pylist()]
            found = [slots(t or "", s) for t, s in zip(part.column("text").to_pylist(), spans, strict=True)]
            columns = [pa.array([sum(s[1] == k for s in b) for b in spans], pa.int64()) for k in range(4)]
            columns.append(pa.array([digest(b, KINDS) for b in spans]))
            columns.append(pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in b] for b in spans], triple))
            keys = ("start", "end", "kind", "instance", "patterns")
            columns.append(pa.array([[dict(zip(keys, x, strict=True)) for x in r] for r in found], slot))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), *columns], names=names)


def fits(word: Column, kind: Column) -> Column:
    """Whether a word has what a discovered one of the kind must have."""
    digits = F.length(F.regexp_replace(word, "[^0-9]", ""))
    out = F.when(kind == 0, F.contains(word, F.lit("@")))
    for k, least in LEAST_DIGITS.items():
        out = out.when(kind == k, digits >= least)
    return F.coalesce(out, F.lit(False))


def discovered(found: DataFrame) -> DataFrame:
    """row, start, end, kind of the slots that confident patterns give away."""
    slot = found.select("row", "doc_id", F.explode("slots").alias("s")).select("row", "doc_id", "s.*")
    slot = slot.withColumn("fits", F.array(*(fits(F.col("instance"), F.lit(k)) for k in range(len(KINDS))))).withColumn("instance", F.sha2("instance", 256))
    edges = slot.select("doc_id", "instance", "kind", "fits", F.explode("patterns").alias("pattern"))
    edges = edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.first("fits").alias("fits"), F.countDistinct("doc_id").alias("docs"))
    edges = spool(edges, "pattern-graph")
    seeds = edges.where("kind >= 0").groupBy("instance").agg(F.max("kind").alias("kind")).withColumn("score", F.lit(1.0))
    scores = seeds
    for turn in range(ROUNDS):
        scored = edges.select("pattern", "instance", "docs", "fits").join(scores, "instance", "left")
        unseen = F.array(*(F.sum(F.when(F.col("score").isNull() & F.col("fits")[k], F.col("docs")).otherwise(0)) for k in range(len(KINDS))))
        total = scored.groupBy("pattern").agg(F.sum("docs").alias("slots"), unseen.alias("unseen"))
        support = scored.where("score is not null").groupBy("pattern", "kind").agg(F.sum(F.col("docs") * F.col("score")).alias("weight"), F.count("*").alias("seeds"), F.sum("docs").alias("in_docs"))
        rule = support.where((F.col("seeds") >= LEAST_SEEDS) & (F.col("in_docs") >= LEAST_DOCS)).join(total, "pattern")
        rule = rule.withColumn("confidence", F.col("weight") / (F.col("slots") - F.col("unseen")[F.col("kind")] + 1))
        rule = rule.where((F.col("confidence") >= CONFIDENT) & (F.col("weight") >= LEAST_SHARE * F.col("slots")))
        rule = spool(rule.select("pattern", "kind", "confidence"), "patterns")
        if rule.isEmpty():
            if not turn:
                return slot.where("false").select("row", "start", "end", "kind")
            break
        unlabelled = edges.where("kind < 0").select("pattern", "instance", "fits").join(rule, "pattern").where(F.col("fits")[F.col("kind")])
        voted = unlabelled.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence") * 0.999)))).alias("score"))
        best = voted.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b")).select("instance", F.col("b.kind").alias("kind"), F.col("b.score").alias("score"))
        scores = spool(seeds.unionByName(best.join(seeds, "instance", "left_anti")), "instances")
    named = scores.where(F.col("score") >= ACCEPTED).select("instance", F.col("kind").alias("_kind"))
    return slot.where("kind < 0").join(named, "instance").select("row", "start", "end", F.col("_kind").alias("kind"))


def find_identifiers(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans and found (the spans as structs) per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    found = spool(rows.mapInArrow(_scan, _FOUND), "identifiers")
    shaped = F.col("kind") >= 0
    words = found.select("row", F.explode("slots").alias("s")).select("row", "s.start", F.col("s.instance").alias("word"))
    more = discovered(found).join(words, ["row", "start"]).where(shaped & fits(F.col("word"), F.col("kind")))
    more = more.groupBy("row").agg(F.collect_list(F.struct("start", (F.col("kind") + 4).alias("kind"), "end")).alias("more"))
    every = F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    ordered = F.transform(F.array_sort(F.transform(every, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))), lambda s: s)
    return found.join(more, "row", "left").select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", joined(ordered, NAMES).alias("spans"), ordered.alias("found"))


def op10_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_identifiers(docs).drop("found")
