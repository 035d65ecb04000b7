"""Best-fit packing of tokenised documents by a configuration linear program.

1. Every document becomes pieces of at most ``CAPACITY`` tokens, counted and check-summed in the
   tasks; the pieces are written once (numbers only).
2. The histogram of piece lengths has at most CAPACITY rows and goes to the driver.
3. A *configuration* is a multiset of lengths that fits into a sequence. The program asks for
   the fewest sequences whose configurations cover the histogram. It is solved by multiplicative weights:
   each length has a weight; knapsack dynamic programming finds the configuration of the
   greatest weight (pricing); it is used as often as its scarcest length allows; the
   weights of the lengths it covers fall.
4. Numbers of configurations are rounded down, and what the rounds leave over is packed by
   best fit on the histogram. Time and plan depend on the lengths there are, not on the number of pieces.
5. Spark deals the pieces out: the r-th piece of a length takes the r-th place that the plan has
   for this length. Ranks come from counts per (length, slice), so a length that a third of
   all pieces have is numbered in many tasks.

Defined cases: a null text is an empty text; an empty document has the one token END; rows
that repeat a doc_id are packed each, ``row`` tells them apart; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vantrail.llm.words import slices
from vantrail.session import spool

CAPACITY = 4096
END = 1
#: Parts of words whose ids a worker remembers, about 50 bytes each; it keeps them from task to task, beside whatever the next stage needs.
REMEMBERED = 500_000
#: The first letter beyond those whose small form is mostly one letter in normal form.
SIMPLE = "\u0250"
#: Rounds of pricing, and how fast the weight of a covered length falls.
ROUNDS = 100
RATE = 1.0
#: Long pieces come first: how much more a token of the longest piece weighs. A configuration must fill this share of a sequence.
LONGER = 0.2
FULL = 0.998
#: Pieces numbered in one task, about.
SLICE_ROWS = 200_000

_PIECES = "doc_id long, row long, piece int, start long, length int, ids_crc32 long"


SPACE, LETTER, NUMBER, OTHER, ODD = range(5)


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """The kind of every character, and the small form of those below SIMPLE. Characters are odd whose small or normal form is not one simple character."""
    kinds, small = np.full(0x110000, ODD, np.uint8), np.arange(ord(SIMPLE), dtype="<u4")
    for c in range(len(small)):
        low, category = chr(c).lower(), unicodedata.category(chr(c))
        if len(low) == 1 and low < SIMPLE:
            small[c] = ord(low)
            kinds[c] = LETTER if category[0] == "L" else NUMBER if category[0] == "N" else OTHER
    kinds[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return kinds, small


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``data[start:start + size]`` one after the other."""
    ends = np.cumsum(sizes)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class WordIds:
    """Ids of texts, put together from the ids of their parts, which are remembered.

    The tokenizer drops white space and none of its rules crosses it, and it cuts simple words into runs of letters, single
    digits and runs of other characters, besides seven endings after an apostrophe, before it merges; so the ids of a text are those of
    these parts one after the other. Words with a character beyond SIMPLE, or with what may begin a special token, are parts as they stand. Parts
    and ids lie in flat arrays, the last used first; a text's parts are found through Arrow dictionaries, not one by one.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])  # simple parts are in normal form
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = pa.array([], pa.large_string())
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _encode_simple(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of simple parts, and how many each has: a part ends where a token ends a word."""
        ids = np.array(self.plain.encode(" ".join(parts), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts):
            raise ValueError("the tokenizer cuts words in another way")
        return ids, np.diff(ends, prepend=0)

    def _encode_odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of any characters: the places of the ids tell the words."""
        coded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(coded.ids, "<u4")
        at = np.fromiter((a for a, _ in coded.offsets), np.int64, len(ids))
        return ids, np.diff(np.searchsorted(at, np.cumsum([0, *(len(w) + 1 for w in words)])))

    def _learn(self, parts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where those of each part begin and how many they are. The parts come first in the memory from now on."""
        place = pc.fill_null(pc.index_in(parts, value_set=self.parts), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = place >= 0
        starts, sizes, data, end = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), [self.ids], len(self.ids)
        starts[known], sizes[known] = self.starts[place[known]], self.sizes[place[known]]
        for fresh, encode in ((~known & ~odd, self._encode_simple), (~known & odd, self._encode_odd)):
            if fresh.any():
                ids, n = encode(parts.filter(pa.array(fresh)).to_pylist())
                starts[fresh], sizes[fresh] = end + np.cumsum(n) - n, n
                data.append(ids)
                end += len(ids)
        ids = np.concatenate(data)
        unused = np.ones(len(self.parts), bool)
        unused[place[known]] = False
        unused = np.flatnonzero(unused)[: max(0, REMEMBERED - len(parts))]
        self.parts = pa.concat_arrays([parts[:REMEMBERED], self.parts.take(pa.array(unused))])
        first, self.sizes = np.concatenate([starts[:REMEMBERED], self.starts[unused]]), np.concatenate([sizes[:REMEMBERED], self.sizes[unused]])
        self.ids, self.starts = _gather(ids, first, self.sizes), np.cumsum(self.sizes) - self.sizes
        return ids, starts, sizes

    def of(self, texts: list[str]) -> list[bytes]:
        kinds, small = _characters()
        chars = np.frombuffer(" ".join([*texts, "   "]).encode("utf-32-le"), "<u4")  # spaces behind the last text, for the looks ahead
        kind = kinds[chars]
        kind[:-1][(chars[:-1] == ord("<")) & (chars[1:] == ord("|"))] = ODD
        low = small[np.minimum(chars, len(small) - 1)]
        before = np.concatenate([[np.uint8(SPACE)], kind[:-1]])
        inside = kind != SPACE
        begins = inside & ((kind != before) | (kind == NUMBER))
        quotes = np.flatnonzero((chars == ord("'")) & (before != OTHER) & (before != ODD))
        one, two = low[quotes + 1], low[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((np.isin(one, [ord("r"), ord("v")])) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        begins[quotes[short | long] + 1] = False
        for there, size in ((short, 2), (long, 3)):
            behind = quotes[there] + size
            begins[behind] = inside[behind]
        odd = np.zeros(len(chars), bool)
        if (kind == ODD).any():
            words = np.flatnonzero(inside & (before == SPACE))
            strange = np.logical_or.reduceat(kind == ODD, words)
            odd = inside & np.repeat(np.concatenate([[False], strange]), np.diff(np.concatenate([[0], words, [len(chars)]])))
            begins[odd] = False
            begins[words[strange]] = True
            low[odd] = chars[odd]
        at = np.flatnonzero(begins)
        low = low[inside]
        bytes_before = np.concatenate([[0], np.cumsum(1 + (low >= 0x80) + (low >= 0x800) + (low >= 0x10000), dtype=np.int64)])
        borders = bytes_before[np.concatenate([np.flatnonzero(begins[inside]), [len(low)]])]
        data = low.tobytes().decode("utf-32-le").encode()
        parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(borders), pa.py_buffer(data)).dictionary_encode()
        codes = parts.indices.to_numpy()
        strange = np.zeros(len(parts.dictionary), bool)
        strange[codes] = odd[at]
        ids, starts, sizes = self._learn(parts.dictionary, strange)
        n = sizes[codes]
        coded = memoryview(_gather(ids, starts[codes], n).tobytes())
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cuts = (4 * np.concatenate([[0], np.cumsum(n)])[np.searchsorted(at, first)]).tolist()
        return [bytes(coded[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@cache
def word_ids(path: str) -> WordIds:
    """One per Python worker: Spark keeps workers from task to task."""
    return WordIds(path)


def _pieces(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        ids = word_ids(path)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            for part in slices(batch, "text"):
                coded = ids.of([t or "" for t in part.column("text").to_pylist()])
                for doc_id, row, data in zip(part.column("doc_id").to_pylist(), part.column("row").to_pylist(), coded, strict=True):
                    data += end
                    for k, a in enumerate(range(0, len(data), 4 * capacity)):
                        piece = data[a : a + 4 * capacity]
                        rows.append((doc_id, row, k, a // 4, len(piece) // 4, zlib.crc32(piece)))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                names = ("doc_id", "row", "piece", "start", "length", "ids_crc32")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    return cut


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return spool(rows.mapInArrow(_pieces(tokenizer, capacity), _PIECES), "pieces")


def best_configuration(lengths: np.ndarray, weights: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each length (ascending) to take: the greatest weight among those that fill FULL to all of the capacity.

    Knapsack dynamic programming over what is filled exactly. All zeros when nothing fills so much.
    """
    best, choice = np.full(capacity + 1, -np.inf), np.full(capacity + 1, -1)
    best[0] = 0.0
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        k = fitting[room]
        if k:
            gains = best[room - lengths[:k]] + weights[:k]
            i = int(gains.argmax())
            best[room], choice[room] = gains[i], i
    least = int(np.ceil(FULL * capacity))
    room = least + int(best[least:].argmax())
    used = np.zeros(len(lengths), np.int64)
    while room > 0 and best[room] > -np.inf:
        used[choice[room]] += 1
        room -= int(lengths[choice[room]])
    return used


Plan = list[tuple[int, list[tuple[int, int]]]]


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """(sequences, [(length, how many)]): a plan that holds every piece of the histogram exactly once.

    In each round the priced configuration is used as often as its scarcest length allows, and
    the weight of every length falls exponentially with the share of it that is covered by then.
    Numbers are rounded down as they arise; what the rounds leave is packed by best fit.
    """
    lengths = np.array(sorted(histogram), np.int64)
    total = np.array([histogram[int(x)] for x in lengths], np.int64)
    left, plan = total.copy(), []
    for _ in range(rounds):
        enough = left >= np.maximum(1, capacity // lengths)  # a configuration never needs more of a length than this
        if not enough.any():
            break
        some, there = lengths[enough], left[enough]
        weights = some * (1 + LONGER * some / capacity) * np.exp(-RATE * (1 - there / total[enough]))
        used = best_configuration(some, weights, capacity)
        if not used.any():
            break  # what is left can no longer fill a sequence
        times = int((there[used > 0] // used[used > 0]).min())
        plan.append((times, [(int(x), int(n)) for x, n in zip(some[::-1], used[::-1], strict=True) if n]))
        left[enough] -= used * times
    return best_fit({int(x): int(n) for x, n in zip(lengths, left, strict=True) if n}, capacity, plan)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY, begun: Plan = ()) -> Plan:
    """Longest pieces first, each into the fullest sequence that has room; ``begun`` are sequences to go on with.

    Sequences with the same contents are one entry with a number, so the work follows the
    number of lengths and not the number of pieces.
    """
    rooms: dict[int, Plan] = {}
    filled = np.zeros(capacity + 1, bool)

    def put(times: int, contents: list[tuple[int, int]], room: int) -> None:
        rooms.setdefault(room, []).append((times, contents))
        filled[room] = True

    for times, contents in begun:
        put(times, contents, capacity - sum(x * n for x, n in contents))
    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count:
            place = np.flatnonzero(filled[length:])
            room = length + int(place[0]) if len(place) else capacity
            times, contents = rooms[room].pop() if len(place) else (count, [])
            filled[room] = bool(rooms.get(room))
            each = room // length
            whole = min(times, count // each)
            if whole:
                put(whole, [*contents, (length, each)], room - each * length)
                count, times = count - whole * each, times - whole
            if count and count < each and times:
                put(1, [*contents, (length, count)], room - count * length)
                count, times = 0, times - 1
            if times and contents:
                put(times, contents, room)
    return [one for some in rooms.values() for one in some]


def _places(plan: Plan) -> pd.DataFrame:
    """Per length and configuration: the first rank it takes, pieces in each sequence, its first sequence, and where they begin in it."""
    rows, first, taken = [], 0, {}
    for times, contents in plan:
        offset = 0
        for length, each in contents:
            start = taken.get(length, 0)
            rows.append((length, start, each, first, offset))
            taken[length] = start + each * times
            offset += length * each
        first += times
    return pd.DataFrame(rows, columns=["length", "rank", "each", "first", "offset"])


def _deal(places: pd.DataFrame):
    columns = ("rank", "each", "first", "offset")
    by_length = {int(k): [v[c].to_numpy() for c in columns] for k, v in places.groupby("length")}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sequence, offset = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            ranks = f["rank"].to_numpy(np.int64)
            for length, at in f.groupby("length").indices.items():
                starts, each, first, begin = by_length[int(length)]
                k = np.searchsorted(starts, ranks[at], side="right") - 1
                within = ranks[at] - starts[k]
                sequence[at] = first[k] + within // each[k]
                offset[at] = begin[k] + within % each[k] * int(length)
            yield f.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return deal


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    cut = pieces(docs, tokenizer, capacity)
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    places = _places(solve(histogram, capacity))
    slices = max(1, -(-sum(histogram.values()) // SLICE_ROWS)) * 8
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("row", "piece"), F.lit(slices)).cast("int"))
    sizes = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("length", "slice").orderBy("row", "piece")) - 1
    ranked = sliced.withColumn("within", within).join(before, ["length", "slice"]).withColumn("rank", F.col("before") + F.col("within"))
    ranked = ranked.select("doc_id", "row", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "rank")
    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInPandas(_deal(places), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 4096 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, default_tokenizer()).drop("row")
