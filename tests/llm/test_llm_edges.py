"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import json
import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bpe, chat, components, families, jaccard, licenses, packing, pages, pretoken, quality, search, substrings, unigram

JSON_BPE, RANKS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["uid", "id", "row", "grp", "bucket", "kept", "n", "node", "own", "label", "length", "piece", "gap", "_q", "_row", "_kept", "n_words", "tokens"]


def words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 8))) for _ in range(n))


LONG = words(1, 20_000)
SHARED = words(2, 70)
ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", None), (4, "one two", "en", None, 7),
    (5, LONG, "en", "a", len(LONG)), (6, LONG + " tail", None, None, None), (7, words(3, 90) + "\n" + SHARED + "  " + words(4, 30), "fr", "b", 1),
    (8, SHARED.upper() + " " + words(5, 80), "fr", "b", 1), (9, words(6, 60) + " " + SHARED, "fr", "b", 1), (10, SHARED, "fr", "b", 1),
    (11, "a " * 400, "en", "a", 1), (12, "a " * 400, "en", "a", 1), (13, "All rights reserved. CC-BY 4.0; the GNU General Public License, version 3", "en", "a", 1),
    (14, "x" * 5000, "de", "c", 1), (15, "日本語　テキスト 😀   it's 'll", "ja", "c", 1), (16, words(7, 120), "en", "a", 1), (17, words(7, 118) + " z q", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


PAIRS = [(r[0], r[1]) for r in ROWS]


def test_packing(spark, docs, empty):
    found = packing.packed(docs, JSON_BPE).toPandas()
    t = brute.hf_tokenizer()
    sizes = {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in PAIRS}
    assert found.groupby("doc_id").length.sum().to_dict() == sizes
    assert sorted(found[found.doc_id == 1].length) == [1]
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert packing.packed(empty, JSON_BPE).count() == 0
    # repeated rows and rows without an id are documents of their own
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert packing.packed(twice, JSON_BPE).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()[0].n == 12


@pytest.mark.parametrize("seed", range(3))
def test_packing_is_close_to_sequential_best_fit(spark, seed):
    rnd = random.Random(seed)
    kinds = [lambda: rnd.randint(1, 64), lambda: rnd.randint(1, 30), lambda: rnd.choice([3, 21, 22, 43, 64])]
    lengths = [kinds[seed]() for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    rows = packing.assign(items, 64).join(items, "uid").toPandas().sort_values(["sequence_id", "offset"])
    assert len(rows) == 3000 and rows.uid.nunique() == 3000
    ends = rows.groupby("sequence_id").length.cumsum()
    assert ends.max() <= 64 and (ends - rows.length == rows.offset).all()
    assert rows.sequence_id.nunique() <= 1.03 * brute.best_fit_decreasing(lengths, 64) + 1


def test_sweep_crosses_ranges(spark, monkeypatch):
    """Many small ranges give as valid a packing as one."""
    monkeypatch.setattr(packing, "ROWS_PER_TASK", 7)
    items = spark.createDataFrame([(k, 1 + k * 37 % 16) for k in range(120)], "uid long, length long")
    rows = packing.assign(items, 16).join(items, "uid").toPandas()
    assert rows.uid.nunique() == 120 and rows.groupby("sequence_id").length.sum().max() <= 16


def test_extraction(spark, empty):
    page = "<html><body><nav><ul><li><a href=x>home</a></ul></nav><article><h1>A &amp; B</h1><p>one\n two<br>three<p>4 &lt; 5</article><footer>c</footer>"
    table = [(1, "u", None), (2, "u", ""), (3, None, page), (3, None, page), (4, "u", "plain text"), (5, "u", "<script>var a='</p>'</script>"), (6, "u", "<p" + " x" * 5000)]
    df = spark.createDataFrame(table, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit(2), "h": F.lit(3)})
    rows = got(pages.extracted(df))
    assert len(rows) == 7 and rows[0][2:] == ("", 0) and rows[1][2:] == ("", 0)
    assert rows[2] == rows[3] and rows[2][3] == len(rows[2][2])
    assert pages.extracted(df.limit(0)).count() == 0


def test_blocks_of_a_page():
    page = "<title>t</title><nav><a href='x'>home</a></nav><article><h1>A &amp;\n B</h1><p>one<br>two <b>bold</b><p>three<!-- no --><style>p{}</style></article>"
    found = pages.blocks(page)
    assert [t for _, t, _ in found] == ["home", "A & B", "one two bold", "three"]
    assert [path.element[0] for path, _, _ in found] == ["nav", "h1", "p", "p"] and found[0][2] == 4


@pytest.mark.parametrize("inside", ["for(i=0;i<n;i++){f()}", "var s='<!--';", "if (a<b) x='</p>'", "x = '</scripts>' + \"'\"", "/* it's */"])
@pytest.mark.parametrize("name", ["script", "STYLE", "textarea"])
def test_raw_elements_end_at_their_own_closing_tag(name, inside):
    page = f"<article><p>one</p><{name}>{inside}</{name.swapcase()} ><p>two</p><svg><{name}>{inside}</{name}><path d='M'/></svg><p>three</article>"
    if name != "textarea":  # one that is never closed is passed over, its text stays
        page += f"<{name}>{inside}"
    assert [t for _, t, _ in pages.blocks(page)] == ["one", "two", "three"]


def test_formulas_and_objects_are_text():
    page = "<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be<object data=f><p>a &lt; b</p></object><script src='f'/><p>end"
    assert [t for _, t, _ in pages.blocks(page)] == ["let x=2 be", "a < b", "end"]


def test_labeller_learns_on_held_out_dresses():
    rng = np.random.default_rng(3)
    made = []
    for k in range(120):
        blocks = [(pages.path_of([("html", ()), ("body", ()), ("article", ()), ("p", ())]), words(1000 + 10 * k + j, 20), 0) for j in range(5)]
        made.append(pages._dressed(blocks, [True] * 5, [words(j, 8) for j in range(50)], rng))
    data = [(pages.vectors(b), np.array(y, np.float32)) for b, y in made]
    model = pages.train(data[:90])
    wrong = sum(int((found != np.array(y)).sum()) for found, (_, y) in zip(pages.label(model, [b for b, _ in made[90:]]), made[90:]))
    assert wrong <= 0.02 * sum(len(y) for _, y in made[90:])


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer, models, normalizers

    pieces, has_bytes = unigram.vocabulary(PIECES)
    spare = [(f"<0x{b:02X}>", min(pieces.values())) for b in range(256)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items(), *spare], 0, has_bytes))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    want = [(i, len(library.encode(t).ids) if t else 0) for i, t in PAIRS]
    assert got(unigram.counted(docs, PIECES)) == want
    assert unigram.counted(empty, PIECES).count() == 0


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_ties_and_unknown_characters(fallback):
    from tokenizers import Tokenizer, models

    rnd = random.Random(11)
    for _ in range(60):
        vocabulary = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))): float(-rnd.randint(1, 4)) for _ in range(8)}
        spare = [(f"<0x{b:02X}>", min(vocabulary.values())) for b in range(256)] if fallback else []
        library = Tokenizer(models.Unigram([("<unk>", min(vocabulary.values())), *vocabulary.items(), *spare], 0, fallback))
        own = unigram.Unigram(vocabulary, fallback)
        for _ in range(20):
            text = "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 12)))
            assert own.count(text) == len(library.encode(text).ids), (vocabulary, text)


def test_search_ties_nulls_and_repeats(spark):
    table = [
        (0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 0.0]),
        (7, None), (8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (None, [9.0, 9.0]), (1, [1.0, 0.0]), (100, [-0.001, 0.0]), (11, [1.0]), (12, []),
    ]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>").withColumns({c: F.lit(0) for c in ("block", "group", "score", "rank", "weights")})
    vectors = search.integer_vectors(df)
    rows = got(search.top_k(vectors, vectors.where("vec_id % 50 = 0")))
    assert [r[1:] for r in rows if r[0] == 0] == [(k + 1, v, 256 * 256) for k, v in enumerate([1, 2, 3, 4, 5])]
    assert [r[1:] for r in rows if r[0] == 50] == [(k + 1, v, 128 * 256) for k, v in enumerate([0, 1, 2, 3, 4])]
    assert [r[1:] for r in rows if r[0] == 100] == [(1, 12, 0), (2, 50, -128), (3, 0, -256), (4, 1, -256), (5, 2, -256)]
    few = search.integer_vectors(df.where("vec_id in (0, 1)"))
    assert got(search.top_k(few, few.where("vec_id = 0"))) == [(0, 1, 1, 65536)]
    assert search.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


@pytest.mark.parametrize("kind, limit", [("float", 3e38), ("double", 1.7e308)])
def test_search_takes_every_finite_vector(spark, monkeypatch, kind, limit):
    """Infinite components of either sign end nothing; scores are exact however large they are."""
    from fractions import Fraction

    rnd = random.Random(21)
    sizes = [1.0, 1e6, 8_388_608.0, 3e9, 1e15, 1e19, limit]
    table = [(k, [float(np.float32(x)) if kind == "float" else x for x in (rnd.choice([-1, 1]) * rnd.random() * rnd.choice(sizes) for _ in range(rnd.randint(1, 4)))]) for k in range(120)]
    table += [(200 + k, [v, 1.0]) for k, v in enumerate([limit, -limit, 8_388_608.0, -8_388_608.0, 1.0, 1.0])]
    bad = [(250, [-float("inf"), 1.0]), (300, [1.0, float("inf")]), (350, [float("nan")]), (400, [None])]
    df = spark.createDataFrame(table + bad, f"vec_id long, embedding array<{kind}>").repartition(3)
    monkeypatch.setattr(search, "BLOCK", 40)
    exact = lambda x: (Fraction(float(np.float32(x)) if kind == "float" else x) * 256).__floor__()
    whole = {i: [exact(x) for x in v] for i, v in table}

    def plain(ids, queries):
        for q in queries:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in ids if i != q)
            yield from [(q, r + 1, i, -s if -(2**63) <= -s < 2**63 else None) for r, (s, i) in enumerate(scores[:5])]

    vectors = search.integer_vectors(df)
    rows = got(search.top_k(vectors, vectors.where("vec_id % 50 = 0")))
    assert rows == list(plain(whole, sorted(i for i in whole if i % 50 == 0))) and rows[0][3] is None
    fitting = vectors.where("vec_id between 202 and 205")
    assert got(search.top_k(fitting, fitting)) == list(plain(range(202, 206), range(202, 206)))


def test_search_blocks_agree_with_one_block(spark, monkeypatch):
    rnd = random.Random(5)
    df = spark.createDataFrame([(k, [round(rnd.uniform(-1, 1), 2) for _ in range(4)]) for k in range(300)], "vec_id long, embedding array<double>")
    vectors = search.integer_vectors(df)
    whole = got(search.top_k(vectors, vectors.where("vec_id % 50 = 0")))
    monkeypatch.setattr(search, "BLOCK", 40)
    monkeypatch.setattr(search, "GROUP", 2)
    assert got(search.top_k(vectors, vectors.where("vec_id % 50 = 0"))) == whole


def test_chat_statuses(spark):
    call = lambda i, name, args, after=None: {"id": i, "name": name, "arguments": args, "after": after}
    say = lambda *calls: json.dumps({"tool_calls": calls})
    result = lambda i, content: json.dumps({"tool_call_id": i, "content": content})
    text = {"text": "é \"q\"", "lower": True}
    table = [
        (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 2, "assistant", ""), (1, 3, "assistant", "{not json"), (1, 4, None, "x"), (None, 1, "assistant", say(call("a", "count_words", text))),
        (1, 5, "assistant", say(call("b", "count_words", text, ["a"]), call("a", "store_line", {"line": 1, "text": "x"}))),
        (1, 6, "tool", result("a", "one")), (1, 7, "tool", result("a", "two")), (1, 6, "tool", result("zz", "?")), (1, 6, "tool", result("a", "one")),
        (1, 8, "assistant", say(call("c", "count_words", {"text": ""}), call("d", "nothing", {}), call("e", "count_words", {"lower": 1, "text": "t"}), call("f", "store_line", {"text": "t"}))),
        (1, 9, "assistant", say(call("g", "count_words", text, ["h"]), call("h", "count_words", text, ["g"]), call("a", "count_words", text), call(None, "count_words", text), call("i", "count_words", text, ["later"]))),
        (2, 0, "tool", result("a", {"b": 1, "a": 2})), (2, 1, "assistant", say(call("later", "count_words", text))),
    ]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("place", "call_id", "kind", "seen")})
    rows = {(r.conv_id, r.turn, r.place, r.call_id): (r.status, r.json) for r in chat.linked(df, chat.TOOLS).collect()}
    status = {k: v[0] for k, v in rows.items()}
    assert status == {
        (1, 5, 0, "a"): "ok", (1, 5, 1, "b"): "no result", (1, 6, 0, "zz"): "orphan",
        (1, 8, 0, "c"): "invalid: text too short", (1, 8, 1, "d"): "unknown tool", (1, 8, 2, "e"): "invalid: lower is not boolean", (1, 8, 3, "f"): "invalid: line missing",
        (1, 9, 0, "a"): "duplicate id", (1, 9, 1, None): "malformed", (1, 9, 2, "i"): "unknown dependency", (1, 9, 3, "g"): "cycle", (1, 9, 4, "h"): "cycle",
        (2, 0, 0, "a"): "orphan", (2, 1, 0, "later"): "no result",
    }
    assert rows[1, 5, 0, "a"][1] == '{"arguments":{"line":1,"text":"x"},"id":"a","name":"store_line","result":"one"}'
    assert rows[1, 5, 1, "b"][1] == '{"arguments":{"lower":true,"text":"é \\"q\\""},"id":"b","name":"count_words"}'
    assert rows[2, 0, 0, "a"][1] == '{"a":2,"b":1}'
    assert chat.linked(df.limit(0), chat.TOOLS).count() == 0


def test_byte_bpe(docs, empty):
    library = brute.tiktoken_encoding()
    rows = {r.doc_id: r for r in bpe.encoded(docs, RANKS).collect()}
    for i, t in PAIRS:
        assert list(rows[i].ids) == library.encode_ordinary(t or "") and bytes(rows[i].decoded).decode() == (t or "")
    assert bpe.digests(empty, RANKS).count() == 0


def test_prefixes_append_and_edit():
    library, vocabulary = brute.tiktoken_encoding(), bpe.vocabulary(RANKS)
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "aa", "b", " ", "the", "ing", "é", "\x00", "日"]) for _ in range(12)).encode()
        piece = bpe.Prefixes(vocabulary, text)
        assert piece.tokens() == library._encode_single_piece(text)
        a = rnd.randint(1, len(text))
        assert piece.tokens(a) == library._encode_single_piece(text[:a])
        piece.replace(a, rnd.randint(a, len(text)), b"xyz")
        piece.append(b" more")
        assert piece.tokens() == library._encode_single_piece(piece.data)


def test_pretokens_follow_the_pattern():
    import regex

    pattern, rnd = regex.compile(public_tokenizers.PATTERN), random.Random(1)
    alphabet = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "B", "é", "日", "1", "²", "!", "-", " ", "　", "😀", "\r\n"]
    for _ in range(800):
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(4)]
        data = "".join(texts).encode()
        points = pretoken.code_points(data)
        docs = pretoken.point_offsets(np.frombuffer(data, np.uint8), np.cumsum([0, *[len(t.encode()) for t in texts]]))
        at = pretoken.pretoken_starts(points, docs).tolist()
        whole = "".join(texts)
        assert [whole[a:b] for a, b in zip(at, [*at[1:], len(whole)])] == [p for t in texts for p in pattern.findall(t)]


def test_long_texts_are_cut_safely():
    table = pretoken.PieceTable(bpe.vocabulary(RANKS).encode_pieces)
    import pyarrow as pa

    (_, ids, ends), = pretoken.coded_chunks(pa.array([LONG]), table, limit=1000)
    assert ids.tolist() == brute.tiktoken_encoding().encode_ordinary(LONG) and ends.tolist() == [0, len(ids)]


def test_substrings(spark, docs, empty):
    rows = substrings.deduplicated(docs).select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
    want = sorted(brute.substring_dedup(PAIRS))
    assert got(rows) == want
    removed = {r[0]: r[2] for r in want}
    assert removed[6] == 20_000 and removed[9] == 70 and removed[10] == 70 and removed[8] == 0
    assert substrings.deduplicated(docs).select("row.*").columns == [c for c in docs.columns if c != "text"]
    assert substrings.deduplicated(empty).count() == 0
    # rows without an id and rows that share one
    table = [(None, SHARED), (5, SHARED), (5, SHARED), (9, SHARED)]
    odd = substrings.deduplicated(spark.createDataFrame(table, "doc_id long, text string")).select("row.doc_id", "n_removed")
    assert got(odd) == [(5, 0), (5, 0), (9, 70), (None, 0)]
    spans = substrings.deduplicated(spark.createDataFrame([(1, SHARED), (2, "x " + SHARED + " y")], "doc_id long, text string"))
    assert [[(s.first, s.last) for s in r.removed] for r in spans.orderBy("row.doc_id").collect()] == [[], [(1, 70)]]


def test_jaccard(spark, docs, empty):
    want = sorted(brute.jaccard_groups(PAIRS))
    assert got(jaccard.grouped(docs)) == want
    component = {r[0]: r[2] for r in want}
    assert component[6] == 5 and component[12] == 11 and component[17] == 16 and component[2] == 2
    assert jaccard.grouped(empty).count() == 0
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns and got(kept.select("doc_id")) == [(i,) for i, _, c in want if i == c]
    odd = spark.createDataFrame([(None, SHARED), (None, SHARED), (7, SHARED + " q"), (3, None)], "doc_id long, text string")
    assert got(jaccard.grouped(odd)) == [(3, 0, 3), (7, 67, 7), (None, 66, 7), (None, 66, 7)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_jaccard_ids_of_any_size_and_type(spark, kind):
    ids = [5 * 10**18, 4_700_000_000_000_000_000, -(2**63), 2**63 - 1, -1, 0, 4_800_000_000_000_000_000]
    texts = [SHARED] * 6 + [words(31, 60)]
    rows = [(str(i) if kind == "string" else i, t) for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    least, alone = min(r[0] for r in rows[:6]), rows[6][0]
    assert got(jaccard.grouped(df)) == sorted([(i, 66, least) for i, _ in rows[:6]] + [(alone, 56, alone)])
    assert got(jaccard.representatives(df).select("doc_id")) == sorted([(least,), (alone,)])


@pytest.mark.parametrize("short, pivots", [(64, 16), (2, 2)])
def test_jaccard_families(spark, monkeypatch, short, pivots):
    """Families of near copies around the threshold, chains included, keep every link."""
    monkeypatch.setattr(families, "SHORT", short)
    monkeypatch.setattr(families, "PIVOTS", pivots)
    rnd, rows = random.Random(4), []
    for family in range(6):
        base = words(50 + family, 60 + 10 * family).split()
        for k in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = words(rnd.random(), 1)
            rows.append((100 * family + k, " ".join(copy)))
            if k % 5 == 0:
                base = copy
    assert got(jaccard.grouped(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(brute.jaccard_groups(rows))


def test_components(spark):
    rnd = random.Random(9)
    pairs = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = sorted((x, root(x)) for x in parent if any(x in p and p[0] != p[1] for p in pairs))
    assert got(components.components(spark.createDataFrame(pairs, "x long, y long"))) == want


def test_quality(spark, docs, empty):
    rows = got(quality.verdicts(docs).drop("kept"))
    assert rows == [(i, *brute.quality_counts(t)) for i, t in PAIRS]
    kept = quality.kept(docs)
    assert kept.columns == docs.columns
    assert got(kept.select("doc_id")) == got(quality.verdicts(docs).where("kept").select("doc_id"))
    assert quality.verdicts(empty).count() == 0 and quality.kept(empty).count() == 0


def test_quality_salted_join_gives_the_same(docs, monkeypatch):
    plain = got(quality.verdicts(docs))
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)
    assert got(quality.verdicts(docs)) == plain


def test_quality_thresholds_follow_the_group(spark):
    """A source whose ordinary texts hold some symbols rejects later than one whose texts hold none."""
    some = lambda k: " " + "#" * (12 + 2 * (k % 7))
    noisy = [(k, words(k, 100) + some(k), "en", "noisy", 1) for k in range(80)] + [(200 + k, words(200 + k, 60) + " " + "#" * 360, "en", "noisy", 1) for k in range(25)]
    clean = [(100 + k, words(100 + k, 100), "en", "clean", 1) for k in range(80)] + [(300 + k, words(300 + k, 100) + some(k), "en", "clean", 1) for k in range(25)]
    verdict = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(noisy + clean, SCHEMA)).collect()}
    assert [i for i, k in sorted(verdict.items()) if not k] == [200 + k for k in range(25)] + [300 + k for k in range(25)]


def test_quality_of_a_corpus_without_symbols_or_repeats_keeps_all(spark):
    rows = [(k, words(k, 80), "en", None, 1) for k in range(40)] + [(100 + k, words(k, 79) + " #", None, "x", 1) for k in range(3)]
    assert all(r.kept for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA)).collect())


def test_licenses(docs, empty):
    rows = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    for i, t in PAIRS:
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_licenses(t)
    assert rows[13].base_labels == "cc-by,gpl,reserved" and licenses.scanned(empty).count() == 0


@pytest.mark.parametrize("before", ["ends in c", "C", "publi", "redistributionc", ""])
def test_license_hints_do_not_depend_on_neighbours(spark, before):
    """A hint that begins in the text before takes nothing from the next text."""
    df = spark.createDataFrame([(1, before), (2, "CC BY"), (3, before)], "doc_id long, text string").coalesce(1)
    r = licenses.scanned(df).where("doc_id = 2").first()
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (1, 0, 0, "cc-by")


@pytest.mark.parametrize(
    "text, label",
    [
        ("licensed under the apache license version 2 0", "apache-2.0"), ("licensed under the apache license 2 0", "apache-2.0"),
        ("released under the mit license", "mit"), ("copyright 2020 by some one all rights reserved", "copyright-notice"),
        ("licensed under cc by nc 4 0", "cc-by-nc-4.0"), ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ],
)
def test_templates_accept(text, label):
    assert label in licenses.scan(text.encode().split())[4]


@pytest.mark.parametrize("text", ["licensed under the apache license version 3 0", "licensed under an apache license version 2 0", "copyright a b c d e f g h i all rights kept"])
def test_templates_reject(text):
    assert licenses.scan(text.encode().split())[4] == set()


def test_digest_of_nothing():
    assert brute.substring_dedup([(1, None)])[0][3] == hashlib.sha256(b"").hexdigest()


def test_chat_takes_only_what_can_be_written_again(spark):
    call = '{"tool_calls":[{"id":%s,"name":"count_words","arguments":{"text":%s}}]}'
    texts = [call % ('"\\ud800"', '"a"'), call % ('"a"', "NaN"), call % ('"b"', "-Infinity"), call % ('"c"', "1e999"), call % ('"d"', '"\\ud83d\\ude00"'), call % ('"e"', '"' + "x" * 300_000 + '"'), '{"tool_calls":[']
    rows = [(1, k, "assistant", t) for k, t in enumerate(texts)] + [(1, 9, "tool", '{"tool_call_id":"\\udfff","content":1}'), (1, 10, "tool", '{"tool_call_id":"d","content":Infinity}')]
    found = chat.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chat.TOOLS).orderBy("turn").collect()
    assert [(r.turn, r.call_id, r.status) for r in found] == [
        (0, None, "malformed"), (1, None, "malformed"), (2, None, "malformed"), (3, None, "malformed"), (4, "d", "no result"), (5, "e", "no result"), (6, None, "malformed")
    ]
    assert found[4].json == '{"arguments":{"text":"😀"},"id":"d","name":"count_words"}' and len(found[5].json) > 300_000


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<article><p>One.<button>Menu<p>Two</p></article><p>x", ["One.", "Menu", "Two", "x"]),
        ("<article><p>One<button>Menu</button> on<p>Two</p></article>", ["One on", "Two"]),
        ("<div>a<select><option>b<option>c</select>d</div>e", ["ad", "e"]),
        ("<svg><svg></svg><p>n</p></svg><p>after", ["after"]),
        ("<p>a<button>b<button>c</button>d</button>e</p>", ["ae"]),
        ("<body><title>T<p>Two<p>three", ["T", "Two", "three"]),
        ('<p title="broken>Three</p><p>four', ["Three", "four"]),
        ('<p title="a > b">five</p>', ["five"]), ('<a data-h="<b>q</b>">six</a>', ["six"]), ("<p>x</p", ["x"]), ("a<textarea>b", ["a", "b"]),
        ("<video><p>n</p><div>m</video>o", ["o"]), ("<section><video><p>n</section>o", ["n", "o"]),
    ],
)
def test_blocks_behind_unclosed_elements(page, texts):
    assert [t for _, t, _ in pages.blocks(page)] == texts


@pytest.mark.parametrize("piece", ["<a ", "<![CDATA[ ", "<div>", "<b><p>", "</i>", "<button>", "<title>", '<p title="', "<!-- ", "<i><p><b>", "<textarea>x"])
def test_a_bad_page_of_a_megabyte_takes_seconds(piece):
    import time

    page = ("x" + piece) * (1_000_000 // (len(piece) + 1))
    start = time.process_time()
    parsed = pages.blocks(page)
    assert pages.vectors(parsed[:1000]).shape[0] == len(parsed[:1000])
    assert time.process_time() - start < 5


def test_pages_of_known_text(spark):
    """Pages put together from known articles and other matter."""
    rnd = random.Random(3)
    rows, want = [], {}
    for k in range(300):
        said = [words(1000 + 40 * k + j, rnd.randint(15, 60)) + "." for j in range(rnd.randint(2, 8))]
        wrap = rnd.choice(['<article class="post">%s</article>', '<main><div class="entry-content">%s</div></main>', '<div id="content">%s</div>'])
        body = "".join(rnd.choice(["<p>%s</p>", "<p>%s", "<h2>%s</h2>", "<blockquote>%s</blockquote>"]) % t.replace(" ", rnd.choice([" ", "\n  ", " <b>", " <!-- c --> ", "&#32;"]), 1) for t in said)
        menu = "<nav><ul>" + "".join(f"<li><a href='/{j}'>{words(j, 2)}</a>" for j in range(rnd.randint(2, 9))) + "</ul></nav>"
        side = f'<aside class="sidebar"><p>{words(5000 + k, 12)}</p></aside><div class="comments"><p>{words(9000 + k, 20)}</p></div>'
        rows.append((k, f"u{k}", f"<html><head><title>t</title><style>p {{}}</style></head><body>{menu}<script>if(a<b){{}}</script>{wrap % body}{side}<footer>{words(7000 + k, 6)}</footer></body></html>"))
        want[k] = "\n".join(said)
    found = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    right = sum(found[k] == want[k] for k in want)
    assert right >= 0.97 * len(want), right


def test_byte_edits_stop_where_the_encoding_agrees_again(monkeypatch):
    vocabulary = bpe.vocabulary(RANKS)
    text = LONG.encode()
    rnd, piece, done = random.Random(6), bpe.Prefixes(vocabulary, text), []
    extend = vocabulary.extend

    def counted(data, last, end=None):
        before = len(last)
        extend(data, last, end)
        done.append(len(last) - before)

    monkeypatch.setattr(vocabulary, "extend", counted)
    for _ in range(20):
        a = rnd.randrange(len(text))
        b, new = min(len(text), a + rnd.randint(0, 9)), rnd.choice([b"", b"x", b" the end", b"\xc3", b" " * 40])
        text = text[:a] + new + text[b:]
        piece.replace(a, b, new)
        assert piece.data == text and len(piece.last) == len(text)
    assert piece.last == bpe.Prefixes(vocabulary, text).last
    assert sum(done[:-1]) < 20 * 8 * vocabulary.longest + 100 < len(text)


def license_text(template: str, rnd: random.Random, change: bool) -> str:
    import re

    out = []
    for optional, wild, word in re.findall(r"\[\[(.*?)\]\]|<<(\d+)>>|(\S+)", template):
        if wild:
            out += words(rnd.randrange(10**6), rnd.randint(0, int(wild) + change)).split()
        elif word or rnd.random() < 0.5:
            out += (word or optional).split()
    if change and rnd.random() < 0.8:
        out[rnd.randrange(len(out))] = rnd.choice(["xyzzy", "the", "license"])
    return rnd.choice([" ", ", ", "\n * "]).join(w.upper() if rnd.random() < 0.1 else w for w in out)


def test_full_license_texts_against_regular_expressions(spark):
    rnd, rows = random.Random(12), []
    every = [t for texts in licenses.TEMPLATES.values() for t in texts]
    for k in range(150):
        parts = [words(k * 3 + j, rnd.randint(0, 12)) for j in range(3)]
        parts.insert(1, license_text(rnd.choice(every), rnd, k % 3 == 0))
        rows.append((k, ". ".join(parts)))
    rows.append((900, ("all rights reserved. cc by " + license_text(licenses.FULL_TEXTS["mit-text"], rnd, False) + " ") * 40))
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {k: brute.license_findings(t, licenses.TEMPLATES) for k, t in rows}
    seen = {x for labels, _ in found.values() for x in labels.split(",")}
    assert len(seen & set(licenses.FULL_TEXTS)) >= 6
