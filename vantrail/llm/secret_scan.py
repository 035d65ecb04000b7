"""Secrets in texts: fixed patterns, and strings that look random by a battery of tests.

A candidate is a run of at least ``SHORTEST`` characters, whichever kinds (capitals, small letters, digits, signs) it
holds. Its encoding is the one with the smallest alphabet that has them all. Three tests ask whether its
symbols are uniform and independent draws: chi-squared of the counts, Wald-Wolfowitz runs
about the middle of the alphabet, and serial correlation. Stouffer's sum combines them into one p-value;
runs that it finds orderly are no secrets.

Of the others a run is a secret when it is found not to be ordinary text. The null hypothesis is a model of
names, paths and words: letter pairs counted in all texts outside of such runs, and the changes between small
letters, capitals, digits and signs that identifiers have; or a repeated or counted-up sequence. By Markov's inequality its
likelihood divided by that of uniform symbols is a p-value. How small it must be is set for each length
class and encoding apart by the Benjamini-Hochberg procedure over the candidates of all documents, so
that of the runs reported a share of at most ``FALSE`` is expected to be what the model takes for ordinary. Orderly
runs stay in the count with a p of 1. Counts of p-values
by class and of letter pairs, tables of fixed size, are all that the procedure needs.

Defined cases: a null or empty text has no spans; rows that repeat a doc_id are scanned each;
columns beyond doc_id and text are not read. Time is linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vantrail.llm.words import slices
from vantrail.session import spool

KINDS = ("assign", "access", "hex", "random")
# Fixed values of the contract.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

SHORTEST = 16
FALSE = 0.01
#: A run is orderly below this p of the battery; about this share of the random strings is lost by it.
ORDERLY = 1e-4
#: p-values are counted in steps of a tenth of a power of ten, down to 10**-30.
STEPS_PER_POWER, LAST_STEP = 10, 300

_CAPITALS, _SMALLS, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding: alphabet. The last one holds every candidate.
ENCODINGS = {
    "hex_capitals": _DIGITS + "ABCDEF",
    "hex_dashes": _DIGITS + "abcdef-",
    "hex_capitals_dashes": _DIGITS + "ABCDEF-",
    "base32": _CAPITALS + "234567",
    "base32_small": _SMALLS + "234567",
    "base36": _CAPITALS + _DIGITS,
    "base36_small": _SMALLS + _DIGITS,
    "licence": _CAPITALS + _DIGITS + "-",
    "licence_small": _SMALLS + _DIGITS + "-",
    "alphanumeric": _CAPITALS + _SMALLS + _DIGITS,
    "base64": _CAPITALS + _SMALLS + _DIGITS + "+/",
    "base64_url": _CAPITALS + _SMALLS + _DIGITS + "_-",
    "any": _CAPITALS + _SMALLS + _DIGITS + "+/_-",
}
_NAMES = list(ENCODINGS)
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}")
_INDEX = [{c: i for i, c in enumerate(sorted(alphabet))} for alphabet in ENCODINGS.values()]


def inferred(run: str) -> int:
    """The encoding with the smallest alphabet that holds every character of the run; of equal ones the first."""
    used = set(run)
    return min((k for k, index in enumerate(_INDEX) if used <= index.keys()), key=lambda k: len(_INDEX[k]))


def p_random(run: str, encoding: int) -> float:
    """How likely uniform independent symbols are to look at least as orderly as ``run``."""
    index = _INDEX[encoding]
    size, n = len(index), len(run)
    x = np.array([index[c] for c in run])
    counts = np.bincount(x, minlength=size)
    chi = float(((counts - n / size) ** 2).sum() / (n / size))
    z_chi = (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    high = x >= size // 2
    a = int(high.sum())
    b = n - a
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * a * b / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = abs(runs - mean) / math.sqrt(spread) if spread > 0 else 6.0
    c = x - x.mean()
    power = float((c * c).sum())
    z_serial = abs(float((c[1:] * c[:-1]).sum()) / power + 1 / n) * math.sqrt(n) if power > 0 else 6.0
    one_sided = [z_chi, *(_normal_quantile(math.erf(min(z, 8.0) / math.sqrt(2))) for z in (z_runs, z_serial))]
    return 0.5 * math.erfc(sum(one_sided) / math.sqrt(3) / math.sqrt(2))


def _normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(min(max(p, 1e-15), 1 - 1e-15))


#: Words that stand in for the texts' own where these are few. Only their letter pairs count.
SAMPLE = """
the quick value of this function returns with another number and should have been there when they would people which their other about
application configuration internationalisation transaction environment controller repository component service factory manager handler
request response message string buffer content index image static assets public private source main test java python script module package
user account customer order product item list table column query database server client session connection network socket address
https www example com org net html xml json http api blob download upload documents resources templates library version release update
create delete remove insert select file folder path directory name type class object method parameter default option setting property
view model layout header footer button window event listener callback error exception warning debug info log level time date year month
der die das und nicht eine werden gesellschaft schifffahrt donau dampf kapitaen verwaltung versicherung geschwindigkeit wissenschaft
les des une dans pour avec plus sont comme mais nous entreprise gouvernement developpement los las una para con por como mas pero este
nosotros gobierno desarrollo empresa informacion della degli anche essere questo quando sviluppo het een van niet voor zijn maar
"""
_LETTER = np.zeros(256, np.int64)
for _i, _c in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
    _LETTER[_c] = _LETTER[_c - 32] = _i + 1
_SMALL, _CAPITAL, _DIGIT, _SIGN, _START = range(5)
#: How often ordinary names go on, by class of the last character, with small letters, capitals, digits and signs.
_CHANGES = np.log(np.array([[0.84, 0.06, 0.05, 0.05], [0.60, 0.30, 0.05, 0.05], [0.25, 0.15, 0.50, 0.10], [0.60, 0.20, 0.19, 0.01], [0.60, 0.25, 0.13, 0.02]]))
_SIGNS = "+/_-"
#: Share of the model's letters that follow no learnt pair; periods that a repeated sequence may have.
_UNLEARNT, _PERIODS = 0.15, 64


def letter_pairs(text: str) -> np.ndarray:
    """Counts of (letter before or none, letter), flat, in what is no candidate."""
    x = _LETTER[np.frombuffer(_RUN.sub(" ", text).encode("ascii", "replace"), np.uint8)]
    return np.bincount(x[:-1] * 27 + x[1:], minlength=729) if len(x) > 1 else np.zeros(729, np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(729, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            for text in part.column("text").to_pylist():
                total += letter_pairs(f" {text or ''}")
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(729), pa.int32()), pa.array(total)], names=["pair", "n"])


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the chance of each letter after each, row 0 for the first of a word."""
    n = (counts + letter_pairs(SAMPLE.replace("\n", " "))).reshape(27, 27)[:, 1:].astype(float)
    return np.log((1 - _UNLEARNT) * (n + 0.1) / (n + 0.1).sum(axis=1, keepdims=True) + _UNLEARNT / 26)


def learnt(docs: DataFrame) -> np.ndarray:
    rows = docs.select("text").mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(729, np.int64)
    for row in rows:
        counts[row["pair"]] = row["n"]
    return letter_model(counts)


def p_ordinary(run: str, encoding: int, model: np.ndarray) -> float:
    """How likely ordinary names, or repeated or counted-up sequences, are to look at least as random as ``run``."""
    n = len(run)
    code = np.frombuffer(run.encode("ascii"), np.uint8)
    letter = _LETTER[code]
    kind = np.where(letter == 0, np.where((code >= 48) & (code <= 57), _DIGIT, _SIGN), np.where(code >= 97, _SMALL, _CAPITAL))
    style = 0.0
    if not (kind == _SMALL).any():  # all in capitals
        kind, style = np.where(kind == _CAPITAL, _SMALL, kind), -math.log(2)
    last = np.concatenate([[_START], kind[:-1]])
    starts = (kind == _CAPITAL) & (last == _SMALL)
    before = np.where(starts, 0, np.concatenate([[0], letter[:-1]]))
    symbol = np.where(letter > 0, model[before, np.maximum(letter, 1) - 1], np.where(kind == _DIGIT, -math.log(10), -math.log(len(_SIGNS))))
    text = style + float(_CHANGES[last, kind].sum() + symbol.sum())
    fits, fails, first = math.log(0.95), math.log(0.05 / 66), -math.log(66)
    ordered = []
    for period in range(1, min(_PERIODS, n // 2) + 1):
        same = int((code[period:] == code[:-period]).sum())
        ordered.append(period * first + same * fits + (n - period - same) * fails)
    step = np.diff(code.astype(np.int64))
    ordered += [first + int((step == d).sum()) * fits + int((step != d).sum()) * fails for d in (1, -1)]
    order = max(ordered) - math.log(len(ordered))
    uniform = -n * math.log(len(_INDEX[encoding]))
    return math.exp(min(0.0, float(np.logaddexp(text, order)) - math.log(2) - uniform))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, known: list[tuple[int, int, int]], model: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, class, step of p) of runs that may be random and no fixed pattern touches."""
    out = []
    for m in _RUN.finditer(text):
        if any(s < m.end() and m.start() < e for s, _, e in known):
            continue
        encoding = inferred(m[0])
        p = p_ordinary(m[0], encoding, model) if p_random(m[0], encoding) >= ORDERLY else 1.0
        step = min(LAST_STEP, int(-math.log10(max(p, 1e-300)) * STEPS_PER_POWER))
        out.append((m.start(), m.end(), encoding * 64 + len(m[0]).bit_length(), step))
    return out


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_FOUND = f"doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base {_SPAN}, runs array<struct<start:int,end:int,class:int,step:int>>"


def digest(spans: list[tuple[int, int, int]], names: tuple[str, ...]) -> str:
    return hashlib.sha256(",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def _scan(model: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triple = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("step", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    spans = base_spans(text or "")
                    rows.append((spans, candidates(text or "", spans, model)))
                columns = [pa.array([sum(s[1] == k for s in b) for b, _ in rows], pa.int64()) for k in range(3)]
                columns.append(pa.array([digest(b, KINDS) for b, _ in rows]))
                columns.append(pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in b] for b, _ in rows], triple))
                columns.append(pa.array([[dict(zip(("start", "end", "class", "step"), c, strict=True)) for c in r] for _, r in rows], run))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "runs"])

    return scan


def reported_from(found: DataFrame) -> dict[int, int]:
    """Per class the step of p from which runs are reported, by Benjamini and Hochberg.

    The table has at most one row per class and step, so it is small whatever the input.
    """
    counts = found.select(F.explode("runs").alias("r")).groupBy("r.class", "r.step").agg(F.count("*").alias("n")).collect()
    by_class: dict[int, dict[int, int]] = {}
    for row in counts:
        by_class.setdefault(row["class"], {})[row["step"]] = row["n"]
    limits = {}
    for kind, steps in by_class.items():
        total, smaller = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            smaller += steps[step]
            if 10 ** (-step / STEPS_PER_POWER) <= FALSE * smaller / total:  # the largest p of the step
                limits[kind] = step
    return limits


def joined(spans: Column, names: tuple[str, ...]) -> Column:
    kinds = F.array(*(F.lit(n) for n in names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans and found (the spans as structs) per row."""
    found = spool(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan(learnt(docs)), _FOUND), "secrets")
    limits = reported_from(found)
    limit = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair)) if limits else F.create_map(F.lit(-1), F.lit(0))
    random = F.filter("runs", lambda r: r["step"] >= F.coalesce(F.try_element_at(limit, r["class"]), F.lit(LAST_STEP + 1)))
    as_span = F.transform(random, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    every = F.array_sort(F.concat("base", as_span))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.size(random).cast("long").alias("n_random"), "base_sha256", joined(every, KINDS).alias("spans"), every.alias("found"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_secrets(docs).drop("found")
