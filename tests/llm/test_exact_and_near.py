"""Exact and near duplicates and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import SF, documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from vantrail.llm import exact, jaccard, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def corpus(spark):
    """Families of near copies of one text, shared passages, exact copies; one family is large."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(4, 60))] for _ in range(25)]
    passage = [rng.choice(words) for _ in range(20)]
    texts = []
    for k in range(260):
        w = list(base[0] if k % 3 == 0 else rng.choice(base))
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.2:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        texts.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
    texts += ["", "a", "a", "A b", " \n "]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5).cache()


def near_by_hand(rows, rule):
    sets = {}
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(w[k : k + rule.size]) for k in range(len(w) - rule.size + 1)} if len(w) >= rule.size else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and rule.den * len(x & y) >= rule.num * len(x | y):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("rule, block", [(jaccard.Rule(3, 90, 100), 400_000), (jaccard.Rule(), 300), (jaccard.Rule(2, 50, 100), 2_000)])
def test_classes_equal_brute_force(corpus, monkeypatch, rule, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(corpus, rule).collect()}
    assert got == near_by_hand(rows_of(corpus), rule)


def test_one_of_each_class(corpus):
    rule = jaccard.Rule()
    want = {i for i, (n, c) in near_by_hand(rows_of(corpus), rule).items() if i == c or not n}
    assert {r["doc_id"] for r in jaccard.one_of_each(corpus, rule).collect()} == want


def test_divide_skip_across_blocks():
    rng = np.random.default_rng(1)
    base = rng.choice(10**6, 60, replace=False).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.95], rng.integers(10**6, 10**7, 2).astype(np.uint64)])) for _ in range(40)]
    side = np.array([i % 2 for i in range(40)])
    rule = jaccard.Rule()
    edges = jaccard.divide_skip(sets, side, rule)
    assert edges and all(side[a] != side[b] for a, b in edges)
    for a, b in edges:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert rule.den * both >= rule.num * (len(sets[a]) + len(sets[b]) - both)


@pytest.mark.parametrize("owner_rows", [250_000, 20])
def test_exact_groups(corpus, monkeypatch, owner_rows):
    monkeypatch.setattr(exact, "OWNER_ROWS", owner_rows)
    rows = rows_of(corpus)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, []).append(i)
    want = {i: (max(by_text[t]), len(by_text[t]), i == max(by_text[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.groups(corpus).collect()}
    assert got == want
    assert {r["doc_id"] for r in exact.deduplicate(corpus).collect()} == {i for i, v in want.items() if v[2]}


def test_exact_odd_cases(odd_documents, documents):
    assert exact.groups(documents().limit(0)).count() == 0
    out = exact.deduplicate(odd_documents)
    assert out.columns == odd_documents.columns
    got = sorted((r["text"] or "" for r in out.collect()))
    assert got == sorted({t or "" for _, t in rows_of(odd_documents)})
    kept = exact.groups(odd_documents).where("kept").select("text_sha256")
    assert kept.count() == kept.distinct().count() == len(got)


def passages_by_hand(rows):
    words = {i: WORD.findall(t) for i, t in rows}
    first = {}
    for i in sorted(words):
        for a in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][a : a + 13]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < i:
                gone[a : a + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("runs", [40_000, 5])
def test_repeats_equal_brute_force(corpus, monkeypatch, runs):
    monkeypatch.setattr(repeats, "GROUP_RUNS", runs)
    want = passages_by_hand(rows_of(corpus))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"], r["kept_sha256"]) for r in repeats.remove_repeats(corpus).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 500


def test_repeats_and_classes_odd_cases(odd_documents, documents):
    assert repeats.remove_repeats(documents().limit(0)).count() == 0
    assert jaccard.classes(documents().limit(0), jaccard.Rule()).count() == 0
    assert repeats.remove_repeats(odd_documents).count() == odd_documents.count()
    found = jaccard.classes(odd_documents, jaccard.Rule(3, 90, 100))
    assert found.count() == odd_documents.count()
    empty = found.where("n_shingles = 0").collect()
    assert len(empty) == 4 and all(r["component_id"] == r["doc_id"] for r in empty)
    assert jaccard.one_of_each(odd_documents, jaccard.Rule(3, 90, 100)).columns == odd_documents.columns


def test_queries_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = rows_of(docs)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.op6_repeats(spark, SF).collect()}
    assert got == {i: (a, b, d) for i, (a, b, _, d) in passages_by_hand(rows).items()}
    near = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op4_jaccard_join(spark, SF).collect()}
    assert near == near_by_hand(rows, jaccard.Rule(3, 90, 100))
    assert docs.where(F.col("text").isNotNull()).count() > 0


def test_null_ids_link(documents):  # noqa: F811
    words = " ".join(f"w{i}" for i in range(60))
    df = documents((None, words), (5, words + " end"), (7, words + " other"), (None, "alone here now"), (None, words))
    rule = jaccard.Rule(3, 90, 100)
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard.classes(df, rule).collect())
    assert got == [(-1, -1), (-1, 5), (-1, 5), (5, 5), (7, 5)]
    kept = [r["doc_id"] for r in jaccard.one_of_each(df, rule).collect()]
    assert sorted(x or -1 for x in kept) == [-1, 5]


def test_words_with_equal_low_bits_are_different(documents):  # noqa: F811
    """The hashes of these two words agree in their low 32 bits."""
    rest = " ".join(f"w{i}" for i in range(12))
    rows = repeats.remove_repeats(documents((1, f"k66998 {rest}"), (2, f"k208235 {rest}"), (3, f"k66998 {rest}"))).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {1: 0, 2: 0, 3: 13}
