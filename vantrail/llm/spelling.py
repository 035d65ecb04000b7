"""Spelling variants: words one edit apart, found by blocked Gram matrices.

1. One scan counts the lower-cased runs of letters. A run whose hash with its doc_id is divisible by 97
   has lost one letter first, as misspelt copies of a word have. Counts are combined per task before
   they are shuffled.
2. Words are dealt to *blocks* by length and by how often they hold each of two frequent letters. One edit
   changes each of these numbers by at most one, so only adjacent blocks can hold a pair. A block is cut
   into *chunks* of a bounded number of letters.
3. For two chunks one product of matrices gives all squared distances between letter counts: with rows
   ``(c, |c|^2, 1)`` and ``(-2 c, 1, |c|^2)`` the product is ``|a - b|^2`` itself. One edit leaves it at two or
   less, so all other pairs end there. Those that stay are compared letter by letter.
4. Every chunk pair sends one row per word, with its number of near words and the best of them, so the
   pairs themselves are never shuffled.
5. Roots are found by doubling: a form has at least twice the count of its word, so chains end, and
   a chain of n words needs about log2(n) joins.

The work of step 3 grows with the product of the sizes of adjacent blocks, the rows sent with that
divided by the size of a chunk. Nothing is capped: each pair of chunks is a task of its own.

Defined cases: a null or empty text has no runs; a null doc_id hashes as an empty id (``:run``); rows that
repeat count again; of near words with the same count the smallest in code-point order is
the form; an empty table gives no rows; a very long run is one word like any other (its
chunks are smaller); columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vantrail.llm.words import slices
from vantrail.session import spool

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Words of which one in this many loses a letter.
LOSS = 97
#: Letters of a chunk, and words of a tile of its matrices (memory: a tile times a chunk).
CHUNK_LETTERS, TILE = 1 << 16, 512
#: Letter counts are folded to so many places; an edit changes the folded counts by no more than the full ones.
PLACES = 32
#: Distinct words that a task holds before it sends their counts.
HELD_WORDS = 400_000
#: The two letters whose counts tell blocks apart. Any two give the same result; frequent ones give smaller blocks.
BLOCK_LETTERS = ("e", "n")
#: Two sets of letters whose counts tell cells inside a chunk apart, in the same way.
CELL_LETTERS = ("aiolu", "tsdhr")

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def runs(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """The distinct words of a text, after the loss of letters, with their counts."""
    lowered = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), prefix)
        if h % LOSS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for part in slices(batch, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                for word, n in runs(doc_id, text or ""):
                    if len(word) >= LEAST_LENGTH:
                        held[word] = held.get(word, 0) + n
            if len(held) >= HELD_WORDS:
                yield flushed()
    yield flushed()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = docs.select("doc_id", "text").mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Folded letter counts of words of one length, given as a matrix of Latin-1 codes."""
    out = np.zeros((len(letters), PLACES), np.float32 if letters.shape[1] <= 1000 else np.float64)
    rows = np.arange(len(letters))
    for column in letters.T:
        out[rows, column % PLACES] += 1
    return out


def _cells(letters: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], tuple[int, int]]]:
    """An order of the rows in which those with as many letters of both ``CELL_LETTERS`` stand together, and where each such cell stands."""
    of = np.stack([np.isin(letters, np.frombuffer(x.encode(), np.uint8)).sum(1) for x in CELL_LETTERS])
    order = np.lexsort(of[::-1])
    cells, first = np.unique(of[:, order], axis=1, return_index=True)
    ends = np.r_[first[1:], len(order)]
    return order, {(int(x), int(y)): (int(s), int(e)) for x, y, s, e in zip(*cells, first, ends, strict=True)}


def close_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b`` whose letter counts are at a squared distance of two or less.

    ``same``: ``b`` is ``a``, and pairs are given once, as i < j. Inside the two chunks the rows stand in cells, as blocks do
    between chunks, and only adjacent cells are multiplied.
    """
    ca, cb = letter_counts(a), letter_counts(b)
    qa, qb = (ca * ca).sum(1, keepdims=True), (cb * cb).sum(1, keepdims=True)
    (order_a, cells_a), (order_b, cells_b) = _cells(a), _cells(b)
    left = np.hstack([ca, qa, np.ones_like(qa)])[order_a]
    right = np.ascontiguousarray(np.hstack([-2 * cb, np.ones_like(qb), qb])[order_b].T)
    found = []
    for (x, y), (start, end) in cells_a.items():
        for near_x in (x - 1, x, x + 1):
            beside = [cells_b[near_x, k] for k in (y - 1, y, y + 1) if (near_x, k) in cells_b]
            if not beside:
                continue
            low, high = beside[0][0], beside[-1][1]  # cells of one row stand side by side
            for tile in range(start, end, TILE):
                hits = np.flatnonzero((left[tile : min(end, tile + TILE)] @ right[:, low:high]).ravel() <= 2)
                i, j = order_a[tile + hits // (high - low)], order_b[low + hits % (high - low)]
                keep = i < j if same else slice(None)
                found.append((i[keep], j[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` differ by exactly one edit; ``b`` has as many letters as ``a`` or one more."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(1) == 1
    front, back = a != b[:, :n], a[:, ::-1] != b[:, :0:-1]
    ahead = np.where(front.any(1), front.argmax(1), n)
    behind = np.where(back.any(1), back.argmax(1), n)
    return ahead + behind >= n


def near(a: np.ndarray, b: np.ndarray, same: bool, step: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    i, j = close_pairs(a, b, same)
    rows = max(1, step // b.shape[1])
    kept = [one_edit(a[i[s : s + rows]], b[j[s : s + rows]]) for s in range(0, len(i), rows)]
    keep = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[keep], j[keep]


def _matrix(words: np.ndarray) -> np.ndarray:
    joined = "".join(words).encode("latin-1")
    return np.frombuffer(joined, np.uint8).reshape(len(words), -1)


def _best(words: np.ndarray, of: np.ndarray, other: np.ndarray, other_words: np.ndarray, other_n: np.ndarray) -> pd.DataFrame:
    """Per word: how many near words, and the one of largest count, the first among equals. ``other_words`` are in order."""
    place = np.empty(len(other_words), np.int64)
    place[np.argsort(-other_n, kind="stable")] = np.arange(len(other_words))
    order = np.lexsort((place[other], of))
    of, other = of[order], other[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(of)])
    return pd.DataFrame({"word": words[of[first]], "n_near": counts, "form_n": other_n[other[first]], "form": other_words[other[first]]})


def _compared(group: pd.DataFrame) -> pd.DataFrame:
    """One pair of chunks, or one chunk with itself."""
    group = group.sort_values("side")
    words = [np.array(list(w), object) for w in group["words"]]
    counts = [np.asarray(n, np.int64) for n in group["counts"]]
    same = len(words) == 1
    wa, wb, na, nb = words[0], words[-1], counts[0], counts[-1]
    i, j = near(_matrix(wa), _matrix(wb), same)
    if same:
        both_i, both_j = np.concatenate([i, j]), np.concatenate([j, i])
        return _best(wa, both_i, both_j, wa, na)
    return pd.concat([_best(wa, i, j, wb, nb), _best(wb, j, i, wa, na)])


def _chunks(words: DataFrame) -> DataFrame:
    """One row per chunk: its block (len, a, b), its number in the block, the words and their counts."""
    first, second = BLOCK_LETTERS
    held = lambda letter: F.length("word") - F.length(F.replace("word", F.lit(letter), F.lit("")))
    keyed = words.select("word", "n", F.length("word").alias("len"), held(first).alias("a"), held(second).alias("b"))
    sizes = keyed.groupBy("len", "a", "b").agg(F.count("*").alias("words"))
    parts = sizes.select("len", "a", "b", F.ceil(F.col("words") * F.col("len") / CHUNK_LETTERS).cast("int").alias("parts"))
    numbered = keyed.join(parts, ["len", "a", "b"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    return numbered.groupBy("len", "a", "b", "part").agg(
        F.sort_array(F.collect_list(F.struct("word", "n"))).alias("rows")
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): of each word with near words their number, and the one of largest count."""
    chunks = spool(_chunks(words), "chunks")
    blocks = chunks.select("len", "a", "b", "part")
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(x).alias("x"), F.lit(y).alias("y")) for k in (0, 1) for x in (-1, 0, 1) for y in (-1, 0, 1)]))
    wanted = blocks.select("len", "a", "b", "part", steps.alias("s")).select(
        *[F.col(c).alias(f"{c}_1") for c in ("len", "a", "b", "part")], (F.col("len") + F.col("s.k")).alias("len"), (F.col("a") + F.col("s.x")).alias("a"), (F.col("b") + F.col("s.y")).alias("b")
    )
    mine, other = F.struct("len_1", "a_1", "b_1", "part_1"), F.struct("len", "a", "b", "part")
    pairs = wanted.join(blocks, ["len", "a", "b"]).where((F.col("len_1") < F.col("len")) | (mine <= other))
    pairs = pairs.withColumn("pair", F.concat_ws(":", "len_1", "a_1", "b_1", "part_1", "len", "a", "b", "part"))
    left = pairs.select("pair", F.lit(0).alias("side"), *[F.col(f"{c}_1").alias(c) for c in ("len", "a", "b", "part")])
    right = pairs.where(mine != other).select("pair", F.lit(1).alias("side"), "len", "a", "b", "part")
    sent = left.unionByName(right).join(chunks, ["len", "a", "b", "part"])
    sent = sent.select("pair", "side", F.col("rows.word").alias("words"), F.col("rows.n").alias("counts"))
    found = sent.groupBy("pair").applyInPandas(_compared, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) and the last word that forms lead to; the word itself if it has none."""
    up = spool(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        after = spool(up.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "roots")
        up = after.select("word", "root")
        if after.where("moved").isEmpty():
            return forms.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: form, root, n, n_near, form_n. Reads doc_id and text."""
    words = spool(word_counts(docs), "words")
    joined = words.join(near_words(words), "word", "left")
    is_form = F.col("form_n") >= 2 * F.col("n")
    forms = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    return with_roots(spool(forms, "forms")).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants among the words of all documents."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
