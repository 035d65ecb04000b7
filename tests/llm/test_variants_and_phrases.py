"""Spelling variants, collocations and SuperMinHash classes against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import SF, documents, odd_documents  # noqa: F401
from test_exact_and_near import corpus, near_by_hand, rows_of  # noqa: F401

from vantrail.llm import jaccard, phrases, spelling, superminhash
from vantrail.llm.automata import Transducer, union


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ---- spelling ------------------------------------------------------------------------------------------------------
def one_edit_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit_apart(w, x)] for w in words}
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: x for w, x in best.items() if words[x] >= 2 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def test_variants(documents, spark):  # noqa: F811
    rng = random.Random(3)
    base = ["letter", "lettre", "strasse", "straße", "étoile", "aaaaa", "banana", "bananas", "x" * 1500]
    words = []
    for w in base:
        words += [w] * rng.randrange(8, 40)
        for _ in range(12):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aené") + w[k + 1 :], w[:k] + rng.choice("zen") + w[k:]])
            words += [v if rng.random() < 0.8 else v.capitalize()] * rng.randrange(2, 6)
    words += ["abcdefg"] * 60 + ["abcdef"] * 20 + ["abcde"] * 7
    rng.shuffle(words)
    texts = [" ".join(words[k::40]) for k in range(40)]
    df = documents(*texts, (None, "letter lettes lettes lettes"), None, "", "  ").repartition(5)
    got = {tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = variants_by_hand(rows_of(df))
    assert got == want
    assert any(r[1] and r[2] != r[1] for r in got), "some chain has two steps"


def test_variants_of_the_table(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {tuple(r) for r in spelling.op11_spelling(spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == variants_by_hand(rows)


def test_small_chunks_give_the_same(spark, monkeypatch):
    whole = {tuple(r) for r in spelling.op11_spelling(spark, SF).collect()}
    monkeypatch.setattr(spelling, "CHUNK_LETTERS", 256)
    assert {tuple(r) for r in spelling.op11_spelling(spark, SF).collect()} == whole


def test_gram_distances_keep_every_edit():
    rng = random.Random(1)
    for size in (5, 6, 9):
        a = sorted({"".join(rng.choice("aenét") for _ in range(size)) for _ in range(150)})
        for b in (a, sorted({"".join(rng.choice("aenét") for _ in range(size + 1)) for _ in range(150)})):
            i, j = spelling.near(spelling._matrix(np.array(a, object)), spelling._matrix(np.array(b, object)), a is b)
            got = set(zip(i.tolist(), j.tolist(), strict=True))
            assert got == {(x, y) for x in range(len(a)) for y in range(len(b)) if (a is not b or x < y) and one_edit_apart(a[x], b[y])}


# ---- phrases -------------------------------------------------------------------------------------------------------
def collocations_by_hand(rows, least, most):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in range(1, 5):
                f[lang].update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q)))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def test_collocations(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(6)] + ["été", "\U0001f600"]
    texts = []
    for k in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", ".\n", "\r"]) for _ in range(60))
        texts.append((rng.choice(["en", "und", None]), text.upper() if k % 9 == 0 else text))
    texts += [("en", "always one phrase here " * 40), ("en", None), ("xx", ""), (None, " . , ")]
    df = spark.createDataFrame([(i, t, x, "s") for i, (x, t) in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(4)
    rows = [(x or "und", t or "") for x, t in texts]
    for least, most in ((30, 2000), (3, 25)):
        got = {tuple(r[c] for c in COLUMNS) for r in phrases.collocations(df, least, most).collect()}
        assert got == collocations_by_hand(rows, least, most)


def test_collocations_do_not_depend_on_the_filter(spark, monkeypatch):
    """A bitmap that is almost full lets everything through; counts stay exact."""
    want = {tuple(r) for r in phrases.op12_collocations(spark, SF).collect()}
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 15)
    monkeypatch.setattr(phrases, "RANGE_PHRASES", 50)
    monkeypatch.setattr(phrases, "HELD_PHRASES", 100)
    monkeypatch.setattr(phrases, "HELD_HASHES", 1000)
    assert {tuple(r) for r in phrases.op12_collocations(spark, SF).collect()} == want


def test_scores_beyond_64_bits(spark):
    """2,000,000 * a passes 2**63 from 4.6e12 occurrences on."""
    df = spark.createDataFrame([(7 * 10**12, 8 * 10**12, 9 * 10**12)], "a long, l long, r long")
    assert df.selectExpr("(cast(a as decimal(19,0)) * 2000000bd) div (cast(l as decimal(19,0)) + r) AS s").first()["s"] == 2_000_000 * 7 // 17


def test_transducers():
    rng = random.Random(2)
    parts = []
    for _ in range(5):
        counts = Counter(tuple(rng.choice([b"a", b"b", b"ab", b"\xc3\xa9"]) for _ in range(rng.randrange(1, 5))) for _ in range(120))
        t = Transducer.of(sorted(counts.items()))
        assert list(t.items()) == sorted(counts.items()) == list(Transducer.unpack(t.pack()).items())
        parts.append((t, counts))
    total = sum((c for _, c in parts), Counter())
    one = union([t for t, _ in parts], 3)
    assert dict(one.items()) == {p: n for p, n in total.items() if n >= 3}
    wanted = Transducer.of((p, 1) for p in sorted(rng.sample(sorted(total), 40)) if len(p) < 4)
    assert dict(one.compose(wanted)) == {p: n for p, n in one.items() if p in dict(wanted.items())}
    assert list(Transducer.of([]).items()) == list(Transducer.unpack(Transducer.of([]).pack()).items()) == []
    same = Transducer.of(sorted({(x, y): 7 for x in (b"p", b"q", b"r") for y in (b"s", b"t")}.items()))
    assert len(same.weights) == 3, "equal ends are one state"


# ---- SuperMinHash --------------------------------------------------------------------------------------------------
def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(4)
    for shared in (100, 200, 270):
        off = []
        for _ in range(30):
            x = rng.integers(0, 2**63, 300).astype(np.uint64)
            half = (300 - shared) // 2
            table = superminhash.superminhash([x[: shared + half], np.concatenate([x[:shared], x[shared + half :]])])
            off.append(float((table[0] == table[1]).mean()) - shared / 300)
        j = shared / 300
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 1.1 * (j * (1 - j) / superminhash.SLOTS) ** 0.5


def test_signatures_by_hand(monkeypatch):
    """Every element offers all slots, one step each, without early stopping and in chunks of any size."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 7, 60, 500)] + [np.zeros(0, np.uint64)]
    whole = superminhash.superminhash(sets, 16)
    assert np.isinf(whole[-1]).all() and not np.isinf(whole[:-1]).any()
    for s, row in zip(sets[:-1], whole[:-1], strict=True):
        kept = np.full(16, np.inf)
        for x in s:
            order = list(range(16))
            for step in range(16):
                draw = int(superminhash.mixed(np.array([x]) + superminhash._STEPS[step])[0])
                at = step + ((draw & 0xFFFFFF) * (16 - step) >> 24)
                order[step], order[at] = order[at], order[step]
                kept[order[step]] = min(kept[order[step]], step + (draw >> 24) * 2.0**-40)
        assert (row == kept).all()
    monkeypatch.setattr(superminhash, "CHUNK", 3)
    assert (superminhash.superminhash(sets, 16) == whole).all()


@pytest.mark.parametrize("rule", [jaccard.Rule(2, 80, 100), jaccard.Rule(1, 90, 100)])
def test_superminhash_classes(corpus, rule, monkeypatch):  # noqa: F811
    want = near_by_hand(rows_of(corpus), rule)
    for block in (superminhash.BLOCK, 3):
        monkeypatch.setattr(superminhash, "BLOCK", block)
        got = superminhash.near_classes(corpus, rule).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"] if r["n_shingles"] else r["doc_id"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_superminhash_links_null_ids(documents):  # noqa: F811
    words = " ".join(f"w{i}" for i in range(60))
    df = documents((None, words + " end"), (5, words), (9, words + " other"), (None, "alone here"), (None, words))
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in superminhash.near_classes(df).collect())
    assert got == [(-1, -1), (-1, 5), (-1, 5), (5, 5), (9, 5)]


def test_superminhash_refuses_lower_similarities(documents):  # noqa: F811
    with pytest.raises(ValueError, match="0.8"):
        superminhash.near_classes(documents("a"), jaccard.Rule(2, 70, 100))


# ---- odd tables ----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("operator", [spelling.variants, phrases.collocations, superminhash.near_classes])
def test_odd_tables(operator, odd_documents):  # noqa: F811
    full = operator(odd_documents)
    rows = full.collect()
    assert operator(odd_documents.where("false")).count() == 0
    if operator is superminhash.near_classes:
        assert len(rows) == odd_documents.count()
    if operator is spelling.variants:
        assert {tuple(r) for r in full.collect()} == variants_by_hand(rows_of(odd_documents))
