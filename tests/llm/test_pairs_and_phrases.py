"""Tokenizer alignment, collocations and MinHash on small tables against plain versions:
nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random
from collections import Counter

import brute
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from test_llm_edges import CLASHES, ROWS, SCHEMA, words

from tidewater.llm import alignment, collocations, families, minhash

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [
    (20, "a  b\t\n\n  c ", "en"), (21, "under▁score and ▁", "en"), (22, "<s> <unk> <0x41> <|endoftext|> </s>", None), (23, " ", None), (24, "é" * 300 + "=" * 5000, ""),
    (25, "日本語。テキスト 😀👨‍👩‍👧   x", "und"), (26, "x" * 3000, "en"), (27, "1234567890 " * 40, "en"), (28, "\n", "en"), (-3, "end. End, end; END! end? end: end", "und"),
]
TEXTS = [(r[0], r[1], r[2]) for r in ROWS] + ODD + [(16, ROWS[15][1], "en"), (None, "no id here", "en"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, "s", 1) for i, t, lang in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(i) for i, c in enumerate([*CLASHES, "run", "shard", "lang_", "words", "least", "high"])})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=order)


def order(row):
    return tuple((x is None, x) for x in row)


def test_alignment(docs, empty):
    want = sorted(brute.alignment_rows([(i, t) for i, t, _ in TEXTS]), key=order)
    assert got(alignment.aligned(docs, *PATHS)) == want
    assert alignment.aligned(empty, *PATHS).count() == 0
    assert got(alignment.aligned(docs.where("text is null or text = ''"), *PATHS)) == [r for r in want if r[1] == 0 and r[0] in (1, 2)] + [(None, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_over_many_runs_and_merges(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(k, " ".join(rnd.choice(["the", "naïve", "of", "Xylo", "==", "12", "\n", "phone"]) for _ in range(rnd.randint(0, 40)))) for k in range(300)]
    monkeypatch.setattr(alignment, "FAN_IN", 4)
    df = spark.createDataFrame(rows, "key long, body string").repartition(4)
    spill = alignment.spilled(df, *PATHS, "key", "body", 60, 300)
    assert spill.where("radix is null").count() > 20
    assert got(alignment.aligned(df, *PATHS, "key", "body", 60, 300)) == sorted(brute.alignment_rows(rows))


def test_merge_is_a_plain_sum():
    import numpy as np

    rnd = np.random.default_rng(1)
    blocks = []
    total = Counter()
    for _ in range(30):
        pairs = np.unique(rnd.integers(0, 40, 200) << 18 | rnd.integers(0, 5, 200))
        n = rnd.integers(1, 9, len(pairs))
        blocks.append((pairs, n))
        total.update(dict(zip(pairs.tolist(), n.tolist())))
    found = list(alignment.merged(blocks))
    assert [len(set((p >> 18).tolist())) for p, _ in found] == [1] * len(found)
    assert [x for p, n in found for x in zip(p.tolist(), n.tolist())] == sorted(total.items())


def plain_phrases(rows, least=10, longest=3, top=2000):
    import re

    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in candidates.items():
        inside = [b for q, b in candidates.items() if q[0] == p[0] and len(q) > len(p) and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2))]
        if any(100 * b >= 50 * a for b in inside):
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k]] * f[(p[0], *p[k:])]), k, f[p[:k]], f[(p[0], *p[k:])]) for k in range(2, len(p))]
        score, _, left, right = min(cuts)
        out.append((p[0], " ".join(p[1:]), a, left, right, n[p[0]], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, k + 1, *r[1:]) for k, r in enumerate(mine[:top])]
    return sorted(ranked)


def test_collocations(spark, docs, empty):
    assert got(collocations.collocations(docs)) == plain_phrases(TEXTS)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(docs.where("text is null")).count() == 0
    rnd = random.Random(8)
    vocabulary = ["New", "york", "city", "of", "the", "a", "b.", "ß", "new york,", "ÉA"]
    rows = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30))), rnd.choice(["en", None, "und", "fr", ""])) for k in range(400)]
    df = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows], SCHEMA).repartition(5)
    for least, top in ((10, 2000), (3, 7)):
        found = collocations.frequent(df, least, most=200, chunk=1000)
        assert got(collocations.ranked(*found, top)) == plain_phrases(rows, least, top=top)


def test_a_shard_keeps_what_is_frequent_in_it_alone(spark):
    # ten occurrences in one shard, none in the others; support differs by the shard's share
    rows = [("alpha beta " * 10 if k == 3 else words(k, 120), "en") for k in range(12)]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    phrases, _ = collocations.frequent(df, most=100, chunk=500)
    assert ("en", "alpha beta", 10) in [(r.lang, r.phrase, r.f) for r in phrases.collect()]


def test_large_counts_are_exact(spark):
    big = 900_000_000_000_000
    phrases = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big - 0), ("en", "c", 1, big), ("en", "a c", 2, big - 1)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 4 * big)], "lang string, n long")
    found = {r.phrase: r.score for r in collocations.ranked(phrases, totals).collect()}
    assert found == {"a b": 1_000_000, "a c": 1_000_000 * (big - 1) ** 2 // big**2}


def groups(rows, n, percent):
    want = brute.jaccard_groups([(k, t) for k, (_, t) in enumerate(rows)], n, percent)
    least = {}
    for (k, _, c) in want:
        if rows[k][0] is not None:
            least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    out = []
    for k, size, c in want:
        node = rows[k][0]
        out.append((node, size, least.get(c), node == least.get(c)))
    return sorted(out, key=order)


def test_minhash(docs, empty):
    assert got(minhash.grouped(docs)) == groups([(i, t) for i, t, _ in TEXTS], 4, 80)
    assert minhash.grouped(empty).count() == 0
    assert minhash.grouped(empty.where("text = ''")).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_minhash_ids_of_any_size_and_type(spark, kind):
    text = words(3, 60)
    ids = [5 * 10**18, 4_700_000_000_000_000_000, -(2**63), 2**63 - 1, -1, 0]
    rows = [(i, text + " " + words(9, 2) * (k % 2)) for k, i in enumerate(ids)] + [(7, words(30, 50))]
    rows = [(str(i) if kind == "string" else i, t) for i, t in rows]
    assert got(minhash.grouped(spark.createDataFrame(rows, f"doc_id {kind}, text string"))) == groups(rows, 4, 80)


def test_minhash_long_lists_need_no_pairs_of_all(spark, monkeypatch):
    """Families of near copies whose members are not all alike, in lists longer than the bound."""
    monkeypatch.setattr(families, "SHORT", 3)
    monkeypatch.setattr(families, "PIVOTS", 2)
    rnd = random.Random(2)
    rows = []
    for family in range(4):
        text = words(100 + family, 100).split(" ")
        for _ in range(40):
            # a walk: each copy changes the one before, so the ends of the family are not alike
            text = list(text)
            text[rnd.randrange(100)] = words(rnd.randrange(10**6), 1)
            rows.append((len(rows), " ".join(text)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(minhash.grouped(df)) == groups(rows, 4, 80)


def test_minima_estimate_similarity():
    import numpy as np

    rnd = np.random.default_rng(4)
    a, b, both = (rnd.integers(1 << 63, size=k, dtype=np.uint64) for k in (100, 100, 800))
    least = minhash.minima(np.concatenate([both, a, both, b]), np.array([900, 900]))
    assert abs((least[0] == least[1]).mean() - 0.8) < 0.1
