"""The registered queries over their whole tables (smallest scale) against plain restatements."""

from __future__ import annotations

import html
import re
import zlib

import brute
import numpy as np
import pytest

from quantarium.llm import registry


@pytest.fixture(scope="module")
def docs(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def run(spark, folder, name):
    return [tuple(r) for r in registry.QUERIES[name](spark, folder).collect()]


def test_op1(spark, folder, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in docs}
    out = registry.QUERIES["op1_packing"](spark, folder).toPandas().sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    for r in out.itertuples():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    by = out.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert (by.length.sum() == by.doc_tokens.first()).all() and len(by) == len(docs)
    assert (by.length.cumsum() - out.length == out.start).all()
    assert out.length.sum() / (2048 * out.sequence_id.nunique()) > 0.97


def test_op2(spark, folder):
    out = registry.QUERIES["op2_quotation"](spark, folder).toPandas()
    source = spark.read.parquet(f"{folder}/conversations.parquet").toPandas()
    assert len(out) == len(source) and (out.position == out.turn).all()  # no message there quotes
    both = out.merge(source, on=["conv_id", "turn"])
    assert (both.body == both.text.str.strip()).mean() > 0.99


def test_op3(spark, folder, docs):
    got = run(spark, folder, "op3_quality")
    assert sorted(r[:6] for r in got) == sorted(brute.quality(docs))
    for _, n, _, _, _, repeat, failed, kept in got:
        assert failed == (n < 50 or 100 * repeat > 50 * n) and not (failed and kept)


def test_op4(spark, folder):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = run(spark, folder, "op4_language")
    held = [(d, p) for d, h, p, _ in got if h]
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h, _, _ in got) and len(got) == len(lang)
    assert sum(lang[d] == p for d, p in held) / len(held) > 0.95


def test_op5(spark, folder, docs):
    assert sorted(run(spark, folder, "op5_suffix_dedup")) == sorted(brute.suffix_dedup(docs))


def test_op6(spark, folder, docs):
    assert sorted(run(spark, folder, "op6_near_duplicates")) == sorted(brute.near_duplicates(docs))


def test_op7(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()}
    for page, _, text, n in run(spark, folder, "op7_html_text"):
        article = re.search(r"<article>(.*?)</article>", pages[page], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert text == "\n\n".join(b for b in blocks if b) and n == len(text)


def test_op8(spark, folder, docs):
    got = {r[0]: r for r in run(spark, folder, "op8_lm_scoring")}
    model = base = 0.0
    for d, held, n, known, total, score in brute.lm_base(docs):
        assert got[d][1:5] == (held, n, known, total) and abs(got[d][5] - score) < 1e-6 * abs(score)
        if held:
            model, base = model + got[d][6], base + score
    assert model > base


def test_op9(spark, folder, docs):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t in docs]
    assert sorted(run(spark, folder, "op9_token_counts")) == sorted(want)


def test_op10(spark, folder, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert sorted(run(spark, folder, "op10_decontamination")) == sorted(brute.decontamination(docs, items))
