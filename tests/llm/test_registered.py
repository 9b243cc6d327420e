"""The registered queries on the smallest tables, against SQL or a brute-force version."""

import hashlib
import re
import zlib

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import compare

import __spark_entry__ as entry
from tidewater.llm import chat, licenses, unigram
from tidewater.llm.statements import SQL

QUERIES = entry.queries()


def read(small, name, *columns):
    return pq.read_table(f"{small}/{name}.parquet", columns=list(columns))


@pytest.fixture(scope="module")
def docs(small):
    t = read(small, "documents", "doc_id", "text")
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_all_are_registered():
    names = [q.split("_")[0] for q in QUERIES if q.startswith("op")]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_statement(name, spark, con, small):
    notes = compare(QUERIES[name](spark, small), con, SQL[name])
    assert [n for n in notes if not n.startswith("note")] == []


def test_packing(spark, small, docs):
    found = QUERIES["op1_packing"](spark, small).toPandas()
    t = brute.hf_tokenizer()
    ids = {i: np.array([*e.ids, 0], "<u4") for (i, _), e in zip(docs, t.encode_batch([x or "" for _, x in docs], add_special_tokens=False))}
    for r in found.itertuples():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length <= 2048 and zlib.crc32(piece.tobytes()) == r.ids_crc32
    assert found.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    lone = found.groupby("doc_id").piece.transform("count") == 1
    assert (found[~lone & (found.piece > 0)].length == 2048).all()
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    least = brute.best_fit_decreasing(found.length.tolist(), 2048)
    assert found.sequence_id.nunique() <= 1.02 * least + 1


def test_extraction(spark, small):
    found = {r.page_id: r for r in QUERIES["op2_html_extraction"](spark, small).collect()}
    table = read(small, "pages", "page_id", "html")
    right = blocks = 0
    for i, page in zip(table["page_id"].to_pylist(), table["html"].to_pylist()):
        right += found[i].text == brute.article_text(page or "")
        blocks += 1
        assert found[i].n_chars == len(found[i].text)
    assert len(found) == blocks and right >= 0.98 * blocks


def test_token_counts(spark, small, docs):
    from tokenizers import Tokenizer, models, normalizers

    import public_tokenizers

    pieces, has_bytes = unigram.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    spare = [(f"<0x{b:02X}>", min(pieces.values())) for b in range(256)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items(), *spare], 0, has_bytes))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    want = sorted((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in docs)
    assert rows(QUERIES["op3_token_counts"](spark, small)) == want


def test_chat(spark, small):
    source = spark.read.parquet(f"{small}/conversations.parquet")
    messages = [tuple(r) for r in chat.derived(source).select("conv_id", "turn", "role", "text").collect()]
    want = sorted(brute.tool_rows(messages, set(chat.TOOLS)))
    found = QUERIES["op5_chat_formatting"](spark, small)
    assert sorted(tuple(r) for r in found.select("conv_id", "turn", "call_id", "status", "json").collect()) == want
    kinds = {r[3] for r in want}
    assert kinds >= {"ok", "no result", "cycle", "duplicate id", "malformed", "orphan", "unknown tool", "unknown dependency"}
    # every call stands behind those it waits for
    place = {(r.conv_id, r.call_id): (r.turn, r.place) for r in found.where("status in ('ok', 'no result')").collect()}
    for conv, turn, role, text in messages:
        if role == "assistant":
            for call in chat._calls(text):
                if (conv, call["id"]) in place:
                    assert all(place[conv, a] < place[conv, call["id"]] for a in call["after"] if (conv, a) in place)


def test_byte_bpe(spark, small, docs):
    library = brute.tiktoken_encoding()
    want = []
    for i, t in docs:
        ids = library.encode_ordinary(t or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows(QUERIES["op6_byte_bpe"](spark, small)) == sorted(want)


def test_substrings(spark, small, docs):
    want = sorted(brute.substring_dedup(docs))
    assert rows(QUERIES["op7_substring_dedup"](spark, small)) == want
    assert any(r[2] for r in want)


def test_jaccard(spark, small, docs):
    want = sorted(brute.jaccard_groups(docs))
    assert rows(QUERIES["op10_ngram_jaccard"](spark, small)) == want
    assert any(r[0] != r[2] for r in want)


def test_minhash(spark, small, docs):
    want = sorted((*r, r[0] == r[2]) for r in brute.jaccard_groups(docs, 4, 80))
    assert rows(QUERIES["op13_minhash_dedup"](spark, small)) == want


def test_alignment(spark, small, docs):
    assert rows(QUERIES["op11_tokenizer_alignment"](spark, small)) == sorted(brute.alignment_rows(docs))


def test_quality_counts(spark, small, docs):
    found = QUERIES["op8_quality_rules"](spark, small).drop("kept")
    assert rows(found) == sorted((i, *brute.quality_counts(t)) for i, t in docs)


def test_licenses(spark, small, docs):
    found = {r.doc_id: r for r in QUERIES["op9_license_scan"](spark, small).collect()}
    for i, t in docs:
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_licenses(t)
        if re.search("licen|reserved|permission|redistrib|cc.by", (t or "").lower()):
            assert (r.labels, r.score) == brute.license_findings(t, licenses.TEMPLATES)
        else:
            assert (r.labels, r.score) == ("", 0.0)


def test_pipeline(spark, small):
    """Every stage against a plain version on what the one before it kept."""
    import corpus_pipeline

    kept = spark.read.parquet(f"{small}/documents.parquet")
    columns = kept.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept.toPandas()
        pairs = list(zip(before.doc_id.tolist(), before.text.tolist()))
        kept = stage(spark, kept, small)
        if number < 3:
            assert kept.columns == columns
        after = kept.toPandas()
        if number == 0:
            verdicts = {r[0]: r[1] for r in con_verdicts(small)}
            assert sorted(after.doc_id) == sorted(i for i, good in verdicts.items() if good)
        elif number == 1:
            assert sorted(after.doc_id) == sorted(i for i, _, c in brute.jaccard_groups(pairs) if i == c)
        elif number == 2:
            want = {r[0]: r for r in brute.substring_dedup(pairs)}
            old = dict(pairs)
            for i, text, size in zip(after.doc_id, after.text, after.n_chars):
                assert len(after) == len(pairs)
                if want[i][2]:
                    assert hashlib.sha256(text.encode()).hexdigest() == want[i][3] and size == len(text)
                else:
                    assert text == old[i]
        else:
            assert after.groupby("sequence_id").length.sum().max() <= 2048 and set(after.doc_id) == set(before.doc_id)


def con_verdicts(small):
    from compare import duck

    return duck(small).execute(f"SELECT doc_id, kept FROM ({SQL['op8_quality_rules']})").fetchall()
