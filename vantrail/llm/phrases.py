"""Collocations: frequent phrases that hold together, per language, counted by weighted acyclic automata.

1. *What may be frequent.* A phrase can be frequent only if its parts are. Tasks send the sorted 64-bit hashes of
   their words and word pairs with counts to the owners of ranges of the hashes, who return those that
   reach the least count; then the same is done for triples of frequent pairs, and for the words of such pairs. What
   comes back is a bitmap of fixed size, the only thing broadcast. It drops no frequent phrase; when it is full it
   drops fewer others, and the counts below stay exact.
2. *Shard automata.* Every task counts the phrases that may be frequent, sorts them, and builds one transducer per
   language and prefix range (a range of the hashes of the first two words) incrementally.
3. *Union.* The transducers of a range are merged in order and weights summed; phrases below the least count go.
4. *Parts.* The parts of every candidate are sent to their ranges as an acceptor of their own, which is composed with
   the transducer there.
5. Scores are whole numbers, computed in decimals of 38 digits.

Defined cases: a null or empty text has no words; a null ``lang`` is ``und``, like that name itself; rows that repeat
count again; ties are decided as stated in ``collocations``; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vantrail.llm.automata import Transducer, union
from vantrail.llm.words import Words, mixed, slices, split_words
from vantrail.session import spool

MOST_WORDS = 4
UNKNOWN = "und"
#: Places of the bitmap of what may be frequent: 2,048 rows of 4 KB, whatever the input.
FILTER_BITS = 1 << 26
_CHUNK = 32_768  # bits in one row of bitmap_construct_agg
#: Hashes that a task holds before it sends them, characters of text whose hashes one owner gets, phrases of one prefix range, about.
HELD_HASHES, OWNER_CHARS, RANGE_PHRASES = 1 << 21, 8 << 20, 20_000
#: Phrases that a task holds before it builds their automata.
HELD_PHRASES = 300_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_NEEDED = np.uint64(0xB5297A4D3F84D5B5)
_IS_END = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(_ENDS, np.uint8))
_TO_SPACE = np.where(_IS_END, np.uint8(32), np.arange(256, dtype=np.uint8))


@cache
def _language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Grams:
    """The words of texts and, for phrases of any size from each word on, hashes with their language and whether one piece holds them."""

    def __init__(self, texts: pa.Array, langs: list[str]) -> None:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
        spaced = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_TO_SPACE[data])])
        self.words: Words = split_words(spaced, lower=True)
        ends = np.concatenate([[0], np.cumsum(_IS_END[data])])
        self.piece = ends[self.words.starts]
        self.text = np.repeat(np.arange(len(langs)), self.words.counts())
        self.lang = np.array([_language_hash(x) for x in langs], np.uint64)[self.text]

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        grams, whole = self.words.grams(size)
        n = len(grams)
        ahead = np.minimum(np.arange(n) + size - 1, n - 1)
        return mixed(grams ^ self.lang), whole & (self.piece[ahead] == self.piece) if n else whole

    def phrase(self, at: int, size: int) -> tuple[bytes, ...]:
        w = self.words
        return tuple(w.data[w.starts[k] : w.ends[k]].tobytes() for k in range(at, at + size))


class Bitmap:
    """What may be frequent: one bit for each of FILTER_BITS places, a power of two."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @classmethod
    def of(cls, found: DataFrame) -> Bitmap:
        place = F.pmod("print", F.lit(FILTER_BITS))
        rows = found.select((place / _CHUNK).cast("int").alias("chunk"), (place % _CHUNK).alias("place"))
        filled = rows.groupBy("chunk").agg(F.expr("bitmap_construct_agg(place)").alias("bits")).collect()
        bits = np.zeros((FILTER_BITS // _CHUNK, _CHUNK // 8), np.uint8)
        for row in filled:
            bits[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
        return cls(bits.ravel())

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = (keys & np.uint64(8 * len(self.bits) - 1)).astype(np.int64)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, list[str]]]:
    for batch in batches:
        for part in slices(batch, "text"):
            langs = part.column("lang").to_pylist()
            yield Grams(part.column("text"), langs), langs


def _between(grams: Grams, bitmap: Bitmap, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words from each word on, and whether they are whole and both their longest parts may be frequent."""
    part, whole_part = grams.of(size - 1)
    may = whole_part & bitmap.has(part)
    keys, whole = grams.of(size)
    return keys, whole & may & np.concatenate([may[1:], [False]])[: len(may)]


def _words_of_pairs(grams: Grams, bitmap: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, apart from those that count them, and which stand in a pair that may be frequent."""
    pair, whole = grams.of(2)
    may = whole & bitmap.has(pair)
    return mixed(grams.of(1)[0] ^ _NEEDED), may | np.concatenate([[False], may])[: len(may)]


def _sent_hashes(sizes: tuple[int, ...], owners: int, known: Broadcast | None):
    """Sorted hashes with counts, one message per owner. Behind ``known`` they are those of triples and of the words of pairs."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
            return keys[first], np.add.reduceat(counts, first) if len(first) else counts

        def messages() -> pa.RecordBatch:
            keys, counts = summed()
            held.clear()
            owner = (keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
            cuts = np.searchsorted(owner, np.arange(owners + 1))
            rows = [(o, keys[a:b].tobytes(), counts[a:b].tobytes()) for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["owner", "keys", "counts"])

        size_held = 0
        for grams, _ in _grams(batches):
            every = [grams.of(size) if known is None else _between(grams, known.value, size) for size in sizes]
            for keys, fits in [*every, *([] if known is None else [_words_of_pairs(grams, known.value)])]:
                unique, counts = np.unique(keys[fits], return_counts=True)
                held.append((unique, counts.astype(np.int64)))
                size_held += len(unique)
            if size_held >= HELD_HASHES:
                held[:] = [summed()]
                size_held = len(held[0][0])
                if size_held >= HELD_HASHES // 2:
                    yield messages()
                    size_held = 0
        if held:
            yield messages()

    return send


def _frequent(least: int):
    def owned(messages: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.int64) for k in messages["keys"]])
        counts = np.concatenate([np.frombuffer(c, np.int64) for c in messages["counts"]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return pd.DataFrame({"print": keys[first][np.add.reduceat(counts, first) >= least]})

    return owned


def frequent_hashes(texts: DataFrame, sizes: tuple[int, ...], least: int, owners: int, known: Broadcast | None = None) -> DataFrame:
    sent = texts.mapInArrow(_sent_hashes(sizes, owners, known), "owner int, keys binary, counts binary")
    return spool(sent.groupBy("owner").applyInPandas(_frequent(least), "print long"), "frequent")


def range_of(phrase: tuple[bytes, ...], ranges: int) -> int:
    return zlib.crc32(b" ".join(phrase[:2])) * ranges >> 32


def _shard_automata(known: Broadcast, ranges: int):
    """Rows of (lang, range, words, automaton): one per range and flush, and one without range with the number of words."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap: Bitmap = known.value
        # The phrases of a task: their hashes in order, which phrase each is, and their counts.
        held, which, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        phrases: list[tuple[str, tuple[bytes, ...]]] = []
        totals: dict[str, int] = {}

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["lang", "range", "words", "automaton"])

        def automata() -> pa.RecordBatch:
            parts: dict[tuple[str, int], list] = {}
            for (lang, phrase), count in zip(phrases, counts.tolist(), strict=True):
                parts.setdefault((lang, range_of(phrase, ranges)), []).append((phrase, count))
            return batch_of([(lang, r, None, Transducer.of(sorted(rows)).pack()) for (lang, r), rows in parts.items()])

        for grams, langs in _grams(batches):
            for lang, n in zip(langs, grams.words.counts().tolist(), strict=True):
                totals[lang] = totals.get(lang, 0) + n
            for size in range(1, MOST_WORDS + 1):
                if size == 1:
                    keys, fits = grams.of(1)
                    fits = fits & bitmap.has(keys) & bitmap.has(mixed(keys ^ _NEEDED))
                else:
                    keys, fits = _between(grams, bitmap, size)
                    fits = fits & bitmap.has(keys) if size < MOST_WORDS else fits
                at = np.flatnonzero(fits)
                unique, first, n = np.unique(keys[at], return_index=True, return_counts=True)
                place = np.searchsorted(held, unique)
                known_already = held[np.minimum(place, len(held) - 1)] == unique if len(held) else np.zeros(len(unique), bool)
                counts[which[place[known_already]]] += n[known_already]
                new = np.flatnonzero(~known_already)
                numbers = len(phrases) + np.arange(len(new))
                phrases += [(langs[grams.text[k]], grams.phrase(k, size)) for k in at[first[new]].tolist()]
                counts = np.concatenate([counts, n[new]])
                held, which = np.insert(held, place[new], unique[new]), np.insert(which, place[new], numbers)
            if len(held) >= HELD_PHRASES:
                yield automata()
                held, which, counts, phrases = held[:0], which[:0], counts[:0], []
        yield automata()
        yield batch_of([(lang, None, n, None) for lang, n in totals.items()])

    return build


def _united(least: int):
    def unite(rows: pd.DataFrame) -> pd.DataFrame:
        one = union([Transducer.unpack(a) for a in rows["automaton"]], least)
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "range": rows["range"].iloc[:1], "automaton": [one.pack()]})

    return unite


def _cuts(ranges: int):
    """Of every phrase of two words or more: each way to cut it in two, and the ranges of the parts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"lang": pa.string(), "phrase": pa.string(), "size": pa.int32(), "a": pa.int64(), "k": pa.int32(), "first": pa.string(), "first_range": pa.int32(), "rest": pa.string(), "rest_range": pa.int32()}
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("automaton").to_pylist(), strict=True):
                rows = []
                for phrase, count in Transducer.unpack(data).items():
                    for k in range(1, len(phrase)):
                        parts = [x for p in (phrase[:k], phrase[k:]) for x in (b" ".join(p), range_of(p, ranges))]
                        rows.append((lang, b" ".join(phrase), len(phrase), count, k, *parts))
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.binary() if kind == pa.string() and n else kind).cast(kind) for n, kind in enumerate(kinds.values())], names=list(kinds))

    return cut


def _looked_up(wanted: pd.DataFrame, automata: pd.DataFrame) -> pd.DataFrame:
    """Counts of the wanted phrases of one language and range."""
    phrases = sorted(tuple(p.encode().split(b" ")) for p in wanted["part"])
    acceptor = Transducer.of((p, 1) for p in phrases)
    found = [(b" ".join(p).decode(), n) for a in automata["automaton"] for p, n in Transducer.unpack(a).compose(acceptor)]
    out = pd.DataFrame(found, columns=["part", "f"]).astype({"f": np.int64})
    out.insert(0, "lang", wanted["lang"].iloc[0] if len(wanted) else None)
    return out


def phrase_automata(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """(lang, range, automaton) with all phrases of up to four words and at least ``least`` occurrences; (lang, n) with all words; the number of ranges."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    owners = -(-chars // OWNER_CHARS) or 1
    short = frequent_hashes(texts, (1, 2), least, owners)
    known = spark.sparkContext.broadcast(Bitmap.of(short))
    long = frequent_hashes(texts, (3,), least, owners, known)
    every = short.unionByName(long)
    ranges = -(-every.count() // RANGE_PHRASES) or 1
    known = spark.sparkContext.broadcast(Bitmap.of(every))
    shards = spool(texts.mapInArrow(_shard_automata(known, ranges), "lang string, range int, words long, automaton binary"), "shards")
    totals = shards.where("range is null").groupBy("lang").agg(F.sum("words").alias("n"))
    parts = shards.where("range is not null").select("lang", "range", "automaton")
    united = parts.groupBy("lang", "range").applyInPandas(_united(least), "lang string, range int, automaton binary")
    return spool(united, "automata"), totals, ranges


def collocations(docs: DataFrame, least: int = 30, most: int = 2000) -> DataFrame:
    """Each language's first ``most`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase is cut where it holds together least (on ties at the first such place) and scores ``2,000,000 * a / (l + r)`` there,
    rounded down. Phrases that a longer one explains to four fifths are left out. The order is by score and a, both
    descending, then by phrase.
    """
    automata, totals, ranges = phrase_automata(docs, least)
    fields = "lang string, phrase string, size int, a long, k int, first string, first_range int, rest string, rest_range int"
    cuts = spool(automata.select("lang", "automaton").mapInArrow(_cuts(ranges), fields), "cuts")
    wanted = cuts.select("lang", F.col("first").alias("part"), F.col("first_range").alias("range"))
    wanted = wanted.unionByName(cuts.select("lang", F.col("rest").alias("part"), F.col("rest_range").alias("range"))).distinct()
    found = wanted.groupBy("lang", "range").cogroup(automata.groupBy("lang", "range")).applyInPandas(_looked_up, "lang string, part string, f long")
    found = spool(found, "parts")
    cut = cuts.join(found.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(found.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(cast(a as decimal(19,0)) * 2000000bd) div (cast(l as decimal(19,0)) + r)").alias("score")
    scored = cut.select("lang", "phrase", "size", "a", "k", "l", "r", score)
    lowest = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "size", "a", "c.l", "c.r", "c.score")
    lowest = spool(lowest, "candidates")

    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda s: F.transform(F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice(words, i, s), " ")),
        )
    )
    inside = lowest.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    most_of = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    explained = F.expr("100bd * longer >= 80bd * a")
    kept = lowest.join(most_of, ["lang", "phrase"], "left").where(F.coalesce(~explained, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of every language among all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY 1),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0),
grams AS (SELECT lang, w[i : i + s - 1] AS g, s FROM starts, (VALUES (1), (2), (3), (4)) AS v(s) WHERE i + s - 1 <= len(w)),
f AS (SELECT lang, g, s, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, g, s, a, unnest(range(1, s)) AS k FROM f WHERE s > 1),
scored AS (
  SELECT c.lang, c.g, c.s, c.a, c.k, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1 : c.s]
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, g[i : i + m - 1] AS g, max(a) AS longer FROM (SELECT lang, g, s, a, m, unnest(range(1, s - m + 2)) AS i FROM f, (VALUES (2), (3)) AS v(m) WHERE m < s) GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
), named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
