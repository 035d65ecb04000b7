"""Language of texts and of the spans inside them.

*Learning.* Letters are counted in threes (with word borders) per language over all labelled texts, in
``BUCKETS`` hashed places; the table of log-probabilities is the model. It grows with the number of
languages only. The scripts that a language is written in are learnt alike.

*Labelling.* The script of a word, from fixed ranges of code points, narrows the languages; the sum over
its letters is its score in each. Viterbi's algorithm finds the labels of all words of the text with
the greatest sum, where each change of language costs ``PENALTY``. Where one language throughout is best,
which holds when no stretch of words favours another by more than the penalty, no table is needed.

The text's language is the one of most letters; the score is their share times the probability of this
language against the others over these words.

Defined cases: a text that is null, empty or without letters is ``und`` with score 0, as is every text
when nothing was learnt; ties go to the language that is first by name; labels that are null, or texts that are, teach
nothing; columns beyond doc_id, text and lang are not read. Whole texts count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vantrail.llm.words import mixed, slices

BUCKETS = 1 << 15
PENALTY = 15.0
UNKNOWN = "und"
#: A language is a candidate for words of a script that has at least this share of its letters.
SCRIPT_SHARE = 0.02
#: Letters handled at once in a task; each takes some 60 bytes and 4 per language.
LETTERS = 1 << 19
#: The model has BUCKETS numbers per language and travels to every task.
MOST_LANGUAGES = 500

# First code points of ranges of one script; "other" where none is named.
SCRIPTS = (
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"),
    (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "other"), (0xB80, "tamil"), (0xC00, "telugu"), (0xC80, "other"), (0xE00, "thai"), (0xE80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"), (0xFF21, "latin"), (0xFF5B, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([a for a, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    table = np.zeros(0x110000, bool)
    for c in range(0x110000):
        table[c] = chr(c).isalpha()
    return table


@dataclass
class Letters:
    """All letters of many texts: hashed threes, scripts, and the words and texts they are in."""

    bucket: np.ndarray
    script: np.ndarray
    word_starts: np.ndarray
    text_of_word: np.ndarray
    word_place: np.ndarray  # first letter in its text, in characters of the lower-cased text


def letters_of(texts: list[str]) -> Letters:
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _letters()[code]
    known = np.where(letter, code, 0)
    padded = np.concatenate([[0], known, [0]]).astype(np.uint64)
    three = mixed(padded[:-2] * np.uint64(0x9E3779B1) ^ padded[1:-1] * np.uint64(0x85EBCA77C2B2AE63) ^ padded[2:] * np.uint64(0x27D4EB2F165667C5))
    at = np.flatnonzero(letter)
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]])) if len(letter) else at
    lengths = np.array([len(t) for t in lowered], np.int64)
    begins = np.cumsum(np.concatenate([[0], lengths + 1]))[:-1]
    owner = np.searchsorted(begins, starts, side="right") - 1
    return Letters(
        (three[at] % np.uint64(BUCKETS)).astype(np.int64),
        _SCRIPT[np.searchsorted(_FIRST, code[starts], side="right") - 1],
        np.searchsorted(at, starts),
        owner,
        starts - begins[owner] if len(starts) else starts,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text", LETTERS):
            langs = part.column("lang").to_pylist()
            texts = part.column("text").to_pylist()
            for lang in sorted(set(langs)):
                found = letters_of([t for t, x in zip(texts, langs, strict=True) if x == lang])
                total = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                total[:BUCKETS] += np.bincount(found.bucket, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(found.script, minlength=len(SCRIPT_NAMES))
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])], names=["lang", "place", "n"])


@dataclass
class Model:
    names: list[str]
    log_p: np.ndarray  # BUCKETS x languages
    allowed: np.ndarray  # scripts x languages


def learn(labelled: DataFrame) -> Model:
    """The model of ``labelled`` (text, lang), all of it. The driver gets at most BUCKETS numbers a language."""
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInArrow(_count, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages; the model is made for {MOST_LANGUAGES} at most")
    full = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(names)))
    if names:
        full[table["place"].to_numpy(), np.searchsorted(np.array(names), np.array(table["lang"].to_pylist()))] = table["n"].to_numpy()
    threes, scripts = full[:BUCKETS], full[BUCKETS:]
    smooth = threes + 0.5
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    allowed |= ~allowed.any(axis=1, keepdims=True)  # a script of no language rules out none
    return Model(names, np.log(smooth / smooth.sum(axis=0)).astype(np.float32) if names else smooth.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Label of each word (rows of ``scores``): the greatest sum less ``penalty`` for each change."""
    n, k = scores.shape
    sums = np.cumsum(scores, axis=0)
    best = int(sums[-1].argmax())
    gain = sums - sums[:, [best]]
    low = np.minimum.accumulate(np.concatenate([np.zeros((1, k)), gain]), axis=0)[:-1]
    if (gain - low).max() <= penalty:
        return np.full(n, best)
    back = np.zeros((n, k), np.int32)
    same = np.arange(k)
    now = scores[0].astype(np.float64)
    for t in range(1, n):
        top = int(now.argmax())
        change = now[top] - penalty > now
        back[t] = np.where(change, top, same)
        now = np.where(change, now[top] - penalty, now) + scores[t]
    out = np.empty(n, np.int64)
    out[-1] = int(now.argmax())
    for t in range(n - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


_SPANS = "array<struct<start:int,words:int,lang:string>>"


def _label(model: Model):
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
    letters_at_once = max(1 << 16, min(LETTERS, (1 << 23) // max(1, len(model.names))))

    def label_texts(texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        found = letters_of(texts)
        out = [(UNKNOWN, 0.0, []) for _ in texts]
        if not len(found.word_starts) or not model.names:
            return out
        ends = np.append(found.word_starts[1:], len(found.bucket))
        scores = np.add.reduceat(model.log_p[found.bucket], found.word_starts, axis=0)
        scores[~model.allowed[found.script]] -= 1e4
        lengths = ends - found.word_starts
        cuts = np.searchsorted(found.text_of_word, np.arange(len(texts) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if a == b:
                continue
            labels = viterbi(scores[a:b])
            size = np.bincount(labels, weights=lengths[a:b], minlength=len(model.names))
            main = int(size.argmax())
            total = scores[a:b][labels == main].sum(axis=0, dtype=np.float64)
            odds = np.exp(np.clip(total - total[main], -50, 50))
            first = np.flatnonzero(np.diff(labels, prepend=-1))
            runs = np.diff(np.append(first, b - a))
            spans = [{"start": int(found.word_place[a + f]), "words": int(r), "lang": model.names[labels[f]]} for f, r in zip(first.tolist(), runs.tolist(), strict=True)]
            out[i] = (model.names[main], float(size[main] / size.sum() / odds.sum()), spans)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", letters_at_once):
                rows = label_texts([t or "" for t in part.column("text").to_pylist()])
                columns = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], span_type)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, "lang_pred", "score", "spans"])

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and spans (start in the lower-cased text, words, lang), which replace columns of these names."""
    docs = docs.drop("lang_pred", "score", "spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_label(model), f"{fields}, lang_pred string, score double, spans {_SPANS}")


def held_out() -> Column:
    """Documents that teach nothing."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    named = identify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
