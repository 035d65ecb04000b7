"""Packing, mixing, fingerprints and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from compare import difference, duck
from llm_cases import SF, documents, odd_documents  # noqa: F401
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from vantrail.llm import catalog, exact, jaccard, mixing, multiset, packing


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plan_holds_every_piece_once(histogram):
    for plan in (packing.solve(histogram, 64), packing.best_fit(histogram, 64)):
        held = {}
        for times, contents in plan:
            assert times > 0 and sum(x * n for x, n in contents) <= 64
            for x, n in contents:
                held[x] = held.get(x, 0) + n * times
        assert held == histogram


def test_plan_is_near_the_bound():
    rng = random.Random(1)
    histogram = {}
    for _ in range(20_000):
        x = min(4096, int(rng.lognormvariate(5.5, 1.2)) + 1)
        histogram[x] = histogram.get(x, 0) + 1
    bound = -(-sum(x * n for x, n in histogram.items()) // 4096)
    assert sum(t for t, _ in packing.solve(histogram)) <= bound * 1.002 + 1


def test_pricing_is_the_best_knapsack():
    lengths, weights = np.array([3, 5, 7]), np.array([3.0, 5.5, 7.2])
    used = packing.best_configuration(lengths, weights, 16)
    best = max(a * 3.0 + b * 5.5 + c * 7.2 for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 16)
    assert abs(float(used @ weights) - best) < 1e-9 and int(used @ lengths) <= 16


def check_pieces(rows, texts, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    by_row, by_sequence = {}, {}
    for r in rows:
        by_row.setdefault((r["doc_id"], r["row"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    found = []
    for (doc_id, _), pieces in by_row.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert [r["start"] for r in pieces] == [capacity * k for k in range(len(pieces))]
        assert all(r["length"] == capacity for r in pieces[:-1])
        found.append((doc_id, sum(r["length"] for r in pieces), [r["ids_crc32"] for r in pieces]))
    want = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
        want.append((doc_id, len(ids), [zlib.crc32(ids[a : a + capacity].tobytes()) for a in range(0, len(ids), capacity)]))
    assert sorted(map(str, found)) == sorted(map(str, want))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


def test_pieces_round_trip(odd_documents, spark):
    rows = packing.pack(odd_documents, packing.default_tokenizer(), 256).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in odd_documents.collect()], 256)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs, packing.default_tokenizer()).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)
    full = -(-sum(r["length"] for r in rows) // 4096)
    assert len({r["sequence_id"] for r in rows}) <= full * 1.02 + 1
    assert packing.pack(docs.limit(0), packing.default_tokenizer()).count() == 0


def test_words_turn_over(monkeypatch):
    """The memory of words is bounded and gives the same ids when it is far too small."""
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    ids = packing.WordIds(packing.default_tokenizer())
    texts = ["The cat, the Dog.", "A b c D e? f\x1cg É, ß. Straße! don't", "İx ΣΑΣ. <|endoftext|>, ﬁ"]
    for _ in range(2):
        for t, data in zip(texts, ids.of(texts), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


def test_parts_of_words_are_encoded_once(monkeypatch):
    """Words are put together from parts that other words had: capitals, marks, digits and endings make no new ones."""
    ids = packing.WordIds(packing.default_tokenizer())
    ids.of(["Alpha, beta. gamma! they'll 17"])
    text = "beta,ALPHA! Gamma.beta THEY'LL7"
    with monkeypatch.context() as m:
        m.setattr(ids, "tokenizer", None)
        m.setattr(ids, "plain", None, raising=False)
        got = ids.of([text, ""])
    want = ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert [np.frombuffer(data, "<u4").tolist() for data in got] == [want, []]


def test_ids_of_any_characters():
    """Each character beside letters, marks, digits and apostrophes, as the tokenizer has it."""
    ids = packing.WordIds(packing.default_tokenizer())
    odd = map(chr, [*range(0x2B0), 0x301, 0x345, 0x1680, *range(0x2000, 0x2030), 0x212B, 0x3000, 0x1F600])
    texts = [f"a{c}b {c} {c}{c}X 's{c}t '{c}re 5{c}5 '{c} e{c}" for c in odd]
    texts += ["don't we'll they'Re 've''s '''s <|endoftext|>x <|x", "'", "a'l", "x'r"]
    assert [np.frombuffer(data, "<u4").tolist() for data in ids.of(texts)] == [ids.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_queries_equal_sql(spark, name):
    assert difference(catalog.QUERIES[name](spark, SF), duck(SF), catalog.ORACLE[name]) is None


def test_mix_meets_its_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.lit(10)).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source")
    )
    n = {r["source"]: r["count"] for r in mixing.mix(docs, {"hot": 1.0, "s1": 2.0, "s2": 0.0}).groupBy("source").count().collect()}
    assert abs(n["hot"] / n["s1"] - 0.5) < 0.06 and set(n) == {"hot", "s1"}
    again = mixing.mix(docs.repartition(7), {"hot": 1.0, "s1": 2.0, "s2": 0.0})
    assert {r["source"]: r["count"] for r in again.groupBy("source").count().collect()} == n
    one = mixing.poisson_terms(F.lit(2.0))
    terms = spark.range(1).select(one.alias("t")).first()["t"]
    assert abs(terms[0] - np.exp(-2)) < 1e-12 and abs(terms[3] - np.exp(-2) * (1 + 2 + 2 + 4 / 3)) < 1e-12 and terms[-1] == pytest.approx(1)


def test_mix_repeats_a_rare_source_in_full(spark):
    """A source of 0.01% of the characters needs 5000 copies of each document for half of the mixture."""
    rare = spark.range(4).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"), F.lit("rare").alias("source"))
    common = spark.range(4, 4004).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"), F.lit("common").alias("source"))
    out = mixing.mix(rare.unionByName(common))
    sizes = {r["source"]: r["chars"] for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("chars")).collect()}
    assert abs(sizes["rare"] / 200_000 - 1) < 0.03 and abs(sizes["common"] / 200_000 - 1) < 0.1
    each = out.where("source = 'rare'").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("_copy").alias("copies"), F.max("_copy").alias("last")).collect()
    assert len(each) == 4 and all(abs(r["n"] - 5000) < 350 and r["n"] == r["copies"] == r["last"] for r in each)
    assert len({r["n"] for r in each}) > 1


def test_mix_odd_cases(odd_documents, documents):
    assert mixing.mix(documents().limit(0)).count() == 0
    out = mixing.mix(odd_documents.drop("_copy", "_place"))
    assert out.columns == [*odd_documents.drop("_copy", "_place").columns, "_copy"]
    assert mixing.mix(odd_documents).count() == out.count()


def test_fingerprints_are_of_multisets(documents):
    df = documents("a b.\nc d.\ne f.", "e f.\nc d.\na b.", "a b.\nc d.\nc d.\ne f.", "a b.\nc d.", "e f.", "", None)
    v = {r["doc_id"]: r for r in multiset.with_fingerprints(df, {"v": "text"}).collect()}
    assert v[0]["v"] == v[1]["v"] != v[2]["v"] and v[5]["v"] == v[6]["v"] and not any(v[5]["v"])
    spark = df.sparkSession
    pair = spark.createDataFrame([(v[3]["v"], v[4]["v"], v[0]["v"])], "a array<long>, b array<long>, c array<long>")
    r = pair.select(multiset.combined(F.col("a"), F.col("b")).alias("sum"), multiset.combined(F.col("c"), F.col("b"), True).alias("less")).first()
    assert r["sum"] == v[0]["v"] and r["less"] == v[3]["v"]


def test_likeness_follows_shared_paragraphs(spark):
    lines = [f"line number {i} of it." for i in range(80)]
    rows = [(k, "\n".join(lines[: 40 + k] + [f"own {k} {i}." for i in range(40 - k)])) for k in (0, 20, 40)]
    df = spark.createDataFrame([(k, t, rows[2][1]) for k, t in rows], "k int, text string, whole string")
    out = {r["k"]: r["l"] for r in multiset.with_fingerprints(df, {"a": "text", "b": "whole"}).select("k", multiset.likeness(F.col("a"), F.col("b")).alias("l")).collect()}
    assert out[40] == 1.0 and abs(out[20] - 0.75) < 0.2 and abs(out[0] - 0.5) < 0.25


def test_likeness_error_is_bounded(spark):
    """Against the true likeness of multisets the error has a standard deviation of at most sqrt(2 / 256) = 0.09; four of them bound it."""
    rng = random.Random(8)
    pairs, true = [], []
    for k in range(300):
        shared = (0, 15, 24)[k % 3]
        own = [[f"own {k} {side} {rng.random()}" for _ in range(30 - shared)] for side in (0, 1)]
        both = [f"both {k} {rng.random()}" for _ in range(shared)]
        pairs.append((k, "\n".join(both + own[0]), "\n".join(both + own[1])))
        true.append(shared / 30)
    df = multiset.with_fingerprints(spark.createDataFrame(pairs, "k int, text string, other string"), {"a": "text", "b": "other"})
    got = [r["l"] for r in df.select("k", multiset.likeness(F.col("a"), F.col("b")).alias("l")).orderBy("k").collect()]
    error = np.array(got) - np.array(true)
    assert np.abs(error).max() < 4 * (2 / 256) ** 0.5 and np.abs(error).mean() < 0.06
    assert np.quantile(np.array(got)[::3], 0.95) < 0.2  # documents that share nothing


def test_edits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    want = {}
    for k, (i, t) in enumerate(texts):
        half = len(t) // 2
        want[i] = t[: len(t) - half] + texts[(k + 1) % len(texts)][1][:half]
    got = {r["doc_id"]: r["edited"] for r in multiset.edited_texts(docs.repartition(5)).collect()}
    assert got == want
    rows = multiset.op8_fingerprints(spark, SF).collect()
    assert len(rows) == len(texts) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert sum(r["near_edited"] for r in rows) / len(rows) > sum(r["near_next"] for r in rows) / len(rows) + 0.2


def test_fingerprints_odd_cases(odd_documents, documents):
    assert multiset.document_fingerprints(documents().limit(0)).count() == 0
    assert multiset.document_fingerprints(odd_documents).count() == odd_documents.count()
    assert multiset.document_fingerprints(documents("only one document here")).first()["near_next"] == 1.0


def test_stages_keep_what_they_must(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact_dedup", "near_duplicates", "mix_sources", "pack"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = corpus_pipeline.spool(stage(spark, docs, SF), name)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        now = [r["doc_id"] for r in out.collect()]
        if name == "language":
            assert set(now) == {i for i, t in before.items() if any(map(str.isalpha, t or ""))}
        elif name == "exact_dedup":
            kept = {}
            for r in docs.collect():
                kept[r["text"]] = max(r["doc_id"], kept.get(r["text"], -1))
            assert sorted(now) == sorted(kept.values())
        elif name == "near_duplicates":
            found = jaccard.classes(docs, jaccard.Rule()).collect()
            assert sorted(now) == sorted(r["doc_id"] for r in found if r["doc_id"] == r["component_id"])
        docs = out
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()
    assert exact.groups(docs).where("kept").count() <= docs.count()


def test_stages_odd_cases(odd_documents, spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_documents, odd_documents.limit(0)):
            assert stage(spark, docs, SF).count() >= 0, name
