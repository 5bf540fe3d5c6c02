"""Each operator against a plain restatement, on small tables with the awkward rows."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quantarium.llm import decontaminate, html_text, language, lm_scoring, near_duplicates, packing, quality, quotation, suffix_dedup, token_prefix
from quantarium.llm.byte_pair import encoder

WORDS = "the of and to in is was for on that with as it by at from his her they this which or be are not have an had".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", ",", ".\n"]) + str(r.randrange(40)) * (r.random() < 0.3) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 300)
    long = prose(2, 4000)
    out = [base, base, base.upper(), base + " tail of it", base.replace("the", "a", 3), prose(3, 200) + base[:400], None, "", "   \n ", "one", "two words", "é ü ß 中文字 😀", long, long[:900] + prose(4, 100), "aaaa" * 60, "aaaa" * 60 + "b"]
    out += [prose(i, 120) for i in range(10, 25)] + ["x" * 5000, "<|endoftext|> a b", "tab\tand \x0b more  and\r\n"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Unordered ids, a repeated row, a null id, and columns whose names clash with the operators' own."""
    ids = list(range(len(texts)))
    random.Random(5).shuffle(ids)
    rows = [(i, t, "en", "s", 1.0, "row", 7) for i, t in zip(ids, texts)]
    rows.append(rows[0])
    schema = "doc_id long, text string, lang string, source string, score double, row string, n_words int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < -1")


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path


def test_packing(docs, pairs, empty, path):
    encode = encoder(path("byte_bpe_50k.json"))
    out = packing.pack(docs, path("byte_bpe_50k.json"), capacity=256, with_ids=True)
    rows = out.toPandas()
    tokens = {d: np.frombuffer(encode.ids(t or ""), "<u4").tolist() + [1] for d, t in pairs}
    assert sorted(rows.length.groupby(rows.sequence_id).sum())[-1] <= 256
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert (g.offset == g.length.cumsum() - g.length).all()
    for r in rows.itertuples():
        piece = tokens[r.doc_id][r.start : r.start + r.length]
        assert list(r.ids) == piece and r.doc_tokens == len(tokens[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
    for d in tokens:
        copies = sum(x == d for x, _ in pairs)
        assert rows.length[rows.doc_id == d].sum() == copies * len(tokens[d])
    assert packing.pack(empty, path("byte_bpe_50k.json")).count() == 0


def test_linear_program():
    d = np.zeros(512, dtype=np.int64)
    d[[99, 199, 255, 299, 411]] = [40, 30, 7, 25, 11]
    s = packing.solve(d, 512)
    assert ((s.patterns @ s.uses) >= d - 1e-6).all() and s.bound <= s.uses.sum() <= 1.01 * s.bound
    assert ((np.arange(1, 513) @ s.patterns) <= 512).all()
    a = packing.assign(d, 512)
    room: dict = {}
    for k in np.flatnonzero(d):
        for q in a.sequence(np.full(d[k], k), np.arange(d[k])):
            room[q] = room.get(q, 0) + k + 1
    assert max(room.values()) <= 512 and len(room) <= s.bound + 8


def test_packing_gap_is_told():
    d = np.random.default_rng(5).integers(0, 90, 256)
    with pytest.warns(UserWarning, match="after 3 rounds with a gap"):
        assert packing.solve(d, 256, rounds=3).gap > 1e-3
    assert packing.solve(d, 256).gap <= 1e-3


def test_byte_pair(texts, path):
    e = encoder(path("byte_bpe_50k.json"))
    for t in [*texts, "a  b", "it's  'll \n\n\n", "é　 b  ", "\x1c x"]:
        assert np.frombuffer(e.ids(t or ""), "<u4").tolist() == e.whole.encode(t or "", add_special_tokens=False).ids


def test_quotation(spark):
    rows = [
        (1, 0, "user", "Hello there my friend. How are you?\nSecond line here."), (1, 1, "bot", "On Monday, x wrote:\n> Hello there my\n> friend.  How are YOU?\nFine, thanks."),
        (1, 2, "user", "Other topic."), (1, 3, "bot", ">> hello there my friend.\n> Fine, thanks\nGood."), (1, 4, "user", "> Other topic.\nYes.\n> unknown text\nNo."),
        (2, 0, "user", None), (2, 0, "user", "dup"), (None, 1, "u", "> a"), (3, None, "u", "x"), (2, 1, "b", "> dup\nq"), (2, 2, None, ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = quotation.linked_conversations(df)
    got = {(r.conv, r.turn, r.body): (r.position, r.reply_to, r.thread, r.depth, r.n_quotes, r.n_linked) for r in out.collect()}
    assert got[(1, 1, "Fine, thanks.")] == (1, 0, 0, 1, 1, 2)
    assert got[(1, 3, "Good.")] == (2, 1, 0, 2, 2, 2)
    assert got[(1, 4, "Yes.\nNo.")] == (4, 2, 2, 1, 2, 1)
    assert got[(2, 1, "q")] == (2, 0, 0, 1, 1, 1) and got[(None, 1, "")][1] is None and got[(3, None, "x")][2] is None
    assert len(got) == len(rows)
    assert quotation.linked_conversations(df.where("turn > 99")).count() == 0


def test_long_reply_chain(spark):
    rows = [(1, i, "u", (f"> message number {i - 1} says so\n" if i else "") + f"Message number {i} says so") for i in range(40)]
    out = quotation.linked_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert {r.thread for r in out} == {0} and max(r.depth for r in out) == 39 and all(r.position == r.turn for r in out)


def test_quality_measures(docs, pairs):
    got = found(quality.measure(docs, "text", {"id": docs.doc_id}), "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(brute.quality(pairs), key=repr)


def test_binomial_tail(spark):
    from math import comb

    for k, n, p in ((0, 50, 0.02), (3, 200, 0.05), (7, 1000, 0.02)):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_tail(f"{k}L", f"{n}L", p).alias("x")).first()["x"]
        assert abs(got - exact) < 1e-9
    assert spark.range(1).select(quality.binomial_tail("20L", "200L", 0.05).alias("x")).first()["x"] == 1


def test_quality_cutoffs(spark, empty):
    good = [(i, prose(i, 80), "en") for i in range(1500)]
    junk = [(2000 + i, " ".join(f"{w}###" for w in prose(i, 80).split()), "en") for i in range(150)]
    few = [(3000 + i, prose(i, 80) + " ### ###", "xx") for i in range(5)]
    labels = [(d, 1, 0) for d, *_ in good] + [(d, 0, 0) for d, *_ in junk] + [(99999, 0, 0), (0, None, 0)]
    df = spark.createDataFrame(good + junk + few, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in quality.assess(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert not any(out[d].kept for d, *_ in junk)
    assert sum(not out[d].kept for d, *_ in good) <= quality.RISK * len(good)
    assert all(out[d].kept for d, *_ in few)  # no labels, no cutoff
    none = quality.assess(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert none.count() == 0


def test_language(spark, docs, empty):
    kinds = {"en": WORDS, "fr": "le la les des une est dans que qui pour sur avec pas ne se".split(), "de": "der die das und ist nicht mit von den ein eine zu auf im".split()}
    rows = []
    for i in range(600):
        lang = list(kinds)[i % 3]
        r = random.Random(i)
        rows.append((i, " ".join(r.choice(kinds[lang]) for _ in range(r.randrange(3, 40))), lang))
    rows += [(1000, None, "en"), (1001, "123 ...", "fr"), (1002, "²³", "fr"), (1003, "dierung schichtung", None), (1004, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    out = {r.row.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model, carry=["doc_id"]).collect()}
    held = [(d, lang) for d, _, lang in rows[:600] if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sum(out[d][0] == lang for d, lang in held) / len(held) > 0.97
    assert out[1000] == out[1001] == out[1002] == out[1004] == ("und", 0.0) and out[1003][0] == "de"
    assert all(0 <= s <= 1 for _, s in out.values())
    blank = language.train(empty)
    assert {r.lang_pred for r in language.identify(docs, blank, carry=["doc_id"]).collect()} == {"und"}
    assert language.identify(docs, model).select("row.*").columns == docs.columns
    assert language.identify(empty, model).count() == 0


def test_language_samples_every_label(spark):
    rows = [(i, f"the cat and the dog {i % 7}", "en") for i in range(4000)] + [(9000 + i, "zwei kleine katzen und hunde", "rare") for i in range(4)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=40)
    assert model.languages == ["en", "rare"]
    kept = [sum(zlib.crc32(str(d).encode()) % 4 != 2 for d, _, x in rows if x == lang) for lang in model.languages]
    assert np.allclose(model.prior, np.log(np.array(kept) / sum(kept)))  # of all rows, not of the sample
    assert language.Predictor(model).predict("kleine hunde")[0] == "rare"
    assert language.SAMPLE_ROWS >= 6000


def test_language_reads_small_batches(spark, tmp_path, monkeypatch):
    """The check's executors' heaps grew with read batches of 4096 texts, and held Python workers for a table of one row a label."""
    other, made = spark.newSession(), []  # with Spark's defaults
    other.range(5000).selectExpr("id AS doc_id", "concat('the cat ', id) AS text", "'en' AS lang").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = other.read.parquet(str(tmp_path / "documents.parquet"))
    create = type(other).createDataFrame
    monkeypatch.setattr(type(other), "createDataFrame", lambda self, *a, **k: made.append(create(self, *a, **k)) or made[-1])
    found = language.identify(df, language.train(df, sample_rows=40, label_rows=10), carry=["doc_id"])
    assert len(made) == 1 and "ExistingRDD" not in made[0]._jdf.queryExecution().toString()
    plan = found._jdf.queryExecution().executedPlan()
    assert plan.execute().count() == 5000
    nodes, batches = [plan], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.metrics().contains("numInputBatches"):
            batches.append(node.metrics().apply("numInputBatches").value())
    assert batches and min(batches) >= 5000 / 256
    other.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1000")
    language.identify(df, language.LanguageModel.of([], [], [], np.zeros((0, 0)), [], np.zeros((0, 0))))
    assert other.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "1000"  # the user's own stays


def test_language_trains_in_little_memory_of_the_driver(spark):
    """The words and n-grams came to the driver as rows of Python, 958 bytes each, and passed the check's limit."""
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghijklmnop", k=8)) for _ in range(6000)]
    rows = [(i, " ".join(words[i % 500 * 12 : i % 500 * 12 + 12]), ["en", "fr", "de"][i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    language.train(df.limit(10))  # what is made once is not counted
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        model = language.train(df)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    known = len(model.words) + len(model.grams)
    assert known > 30_000
    assert (most + pa.total_allocated_bytes() - arrow) / known < 250
    learnt = [(t, x) for d, t, x in rows if zlib.crc32(str(d).encode()) % 4 != 2]
    asked = [rows[5][1], words[7] + "s", "abc"]
    for text, (lang, score) in zip(asked, brute.languages(learnt, asked)):
        found = language.Predictor(model).predict(text)
        assert found[0] == lang and abs(found[1] - score) < 1e-3


def test_language_ignores_holdout_labels(spark):
    rows = [(i, prose(i, 20), "en") for i in range(200)]
    wrong = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else lang) for d, t, lang in rows]
    model = language.train(spark.createDataFrame(wrong, "doc_id long, text string, lang string"))
    assert model.languages == ["en"]


def test_suffix_dedup(docs, pairs, empty):
    got = suffix_dedup.drop_repeats(docs, carry=["doc_id"])
    got = found(got.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("s")), "doc_id", "n_bytes", "n_removed", "n_spans", "s")
    assert got == sorted(brute.suffix_dedup(pairs), key=repr)
    assert suffix_dedup.drop_repeats(docs).select("row.*").columns == docs.columns
    assert suffix_dedup.drop_repeats(empty).count() == 0


def test_suffix_dedup_joins_a_carried_text_once(spark, docs):
    """Beside the row that holds it, the text was a column of its own in the join's shuffle and sort."""

    def joined(plan):
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName() == "Join":
            return {below[0].output().apply(i).name() for i in range(below[0].output().size())}
        return joined(below[0])

    carried = suffix_dedup.drop_repeats(docs)
    assert joined(carried._jdf.queryExecution().optimizedPlan()) == {"row", "id", "h"}
    plain = suffix_dedup.drop_repeats(docs, carry=["doc_id"])
    assert joined(plain._jdf.queryExecution().optimizedPlan()) == {"row", "id", "h", "text"}
    columns = ["row.doc_id", "kept", "n_bytes", "n_removed", "spans"]
    assert sorted(map(repr, carried.select(*columns).collect())) == sorted(map(repr, plain.select(*columns).collect()))


def test_suffix_dedup_long_text(spark, monkeypatch):
    base = prose(7, 3000)
    rows = [(2, base), (1, prose(8, 50) + base[5000:9000]), (3, base[100:149]), (4, base[100:150]), (5, base[:3000] + base[2950:])]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    out = []
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.drop_repeats(df, carry=["doc_id"])
    out = found(got.select("row.doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n"), F.sha2("kept", 256).alias("s")), "doc_id", "n_bytes", "n_removed", "n", "s")
    assert out == sorted(brute.suffix_dedup(rows), key=repr)


def test_suffix_order_and_factors():
    rng = np.random.default_rng(1)

    def common(a, b):
        k = 0
        while k < len(a) and a[k] == b[k]:
            k += 1
        return k

    for _ in range(60):
        depth = int(rng.integers(1, 20))
        n = int(rng.integers(depth, 120))
        data = rng.integers(97, 99, n).astype(np.uint8)
        starts = np.sort(rng.choice(n - depth + 1, size=min(n - depth + 1, 50), replace=False))
        own = rng.integers(0, 6, len(starts))
        order, lcp = suffix_dedup.suffix_order(data, starts, depth)
        suffixes = [bytes(data[s : s + depth]) for s in starts]
        assert [suffixes[i] for i in order] == sorted(suffixes)
        assert list(lcp[1:]) == [common(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:])]
        factors = [max([common(suffixes[i], suffixes[j]) for j in range(len(starts)) if own[j] < own[i]], default=0) for i in range(len(starts))]
        assert list(suffix_dedup.longest_previous(data, starts, own, depth)) == factors


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, pairs, empty, k, percent):
    out = near_duplicates.near_duplicates(docs, shingle=k, percent=percent)
    assert found(out, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near_duplicates(pairs, k, percent), key=repr)
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_near_duplicates_groups(spark, monkeypatch):
    """A large group around one text, a chain, and near misses; blocks of four force several a group."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    r = random.Random(3)
    base = [str(r.randrange(10**6)) for _ in range(80)]

    def edited(words, n, seed):
        out, q = list(words), random.Random(seed)
        for _ in range(n):
            out[q.randrange(len(out))] = str(q.randrange(10**9))
        return out

    rows = [(100 + i, " ".join(edited(base, 2, i))) for i in range(25)] + [(50, " ".join(base)), (51, " ".join(base))]
    chain = [str(r.randrange(10**6)) for _ in range(80)]
    for i in range(12):
        chain = edited(chain, 1, 1000 + i)
        rows.append((300 - i, " ".join(chain)))
    out = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    assert found(out, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near_duplicates(rows), key=repr)


PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1><p>The best of the news and the world for you</p></header>
<div id="cookie-notice">We use cookies and the like to be the best for you and for us all.</div><div class="wrap sidebar-left"><article class="post"><header><h1>Title of it</h1></header>
<p>A first paragraph of the article with <a href="x">a link</a> in it &amp; more&nbsp;text.</p><ul class="toc"><li><a href="#1">One</a></li></ul><p>Short.<p>xqz xqz xqz<div class="ad">Buy the thing now</div>
<blockquote>quote of the day</blockquote></article><section id="comments"><article class="comment"><p>I like the article and the rest of it.</p></article></section><aside>rel of the site</aside></div>
<form><label>Name of the user</label></form><footer>(c) the site</footer><script>var a="<p>x</p>"</script></body>"""


def test_html():
    text = html_text.main_text(PAGE)[0]
    assert text == "Title of it\n\nA first paragraph of the article with a link in it & more text.\n\nShort.\n\nxqz xqz xqz\n\nquote of the day"
    for odd, out in ((None, ""), ("", ""), ("plain &lt;text", "plain <text"), ("<p", ""), ("<!-- x", ""), ("a<b", "a"), ("<script>x", ""), ("<p>" * 5000 + "x", "x"), ("<div>" * 3000 + "x", "x")):
        assert html_text.main_text(odd)[0] == out
    story = "The story of the man and the sea is a story that has been told for many years and it will be told again by those who were there when it was first written in the book of the old and of the young, and so it is with all."
    plain = f'<body><div><a href="/">Home</a> <a href="/b">About us</a></div><h2>Story</h2><div>{story}</div><div>Short one.</div><div>&copy; 2020 site</div></body>'
    assert html_text.main_text(plain)[0] == f"Story\n\n{story}\n\nShort one."


def test_html_place_is_not_the_verdict():
    story = "The story of the man and the sea is a story that has been told for many years and it will be told again by those who were there."
    cards = "".join(f"<article><h3>Card {i}</h3><p>Read the rest of it</p></article>" for i in range(3))
    assert story in html_text.main_text(f"<body><div><p>{story}</p></div>{cards}<nav>Home of the site</nav></body>")[0].split("\n\n")
    assert html_text.main_text(f'<body><article><p>{story}</p><ul><li><a href="/a">A source</a></li></ul></article></body>')[0] == f"{story}\n\nA source"
    russian = "Это длинный рассказ о человеке и море, который много лет рассказывали старики в деревне на берегу реки."
    chinese = "很久以前有一位老人住在海边的小村子里他每天都出海打鱼" * 4
    for text in (russian, chinese):
        page = f'<body><nav><a href="/">The home of the site</a></nav><div>{text}</div><div><a href="/b">{text}</a></div></body>'
        assert html_text.main_text(page)[0] == text


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y")], "page_id long, url string, html string, text string")
    out = html_text.extract(df)
    assert sorted(r.n_chars for r in out.collect())[0] == 0 and out.count() == 3 and out.select("row.*").columns == df.columns
    assert html_text.extract(df.where("page_id > 9")).count() == 0


@pytest.fixture
def lm(spark):
    from quantarium.session import Scratch

    def run(df, training=None):
        held = F.coalesce(F.crc32(df.doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))
        return lm_scoring.scored(df, ~held if training is None else training, {c: df[c] for c in df.columns if c != "text"}, Scratch(spark, "t"))

    return run


def test_lm_base(docs, pairs, lm, empty):
    out, counts = lm(docs)
    assert out.select("row.*").columns == [c for c in docs.columns if c != "text"]
    got = {r.row.doc_id: r for r in out.collect()}
    for d, _, n, known, total, base in brute.lm_base(pairs):
        assert (got[d].n_tokens, got[d].n_known, counts.tokens) == (n, known, total) and abs(got[d].base_score - base) < 1e-6 * max(1, abs(base)) and got[d].score < 0
    assert out.count() == len(pairs)
    assert lm(empty)[0].count() == 0
    untrained, counts = lm(docs, F.lit(False))
    assert counts.tokens == 0 and untrained.where("n_known > 0 OR base_score <> 0").count() == 0


def test_lm_score_against_exact_counts(docs, pairs, lm):
    """Bloom levels and sent keys give what plain dictionaries of exact counts give, but for quantising and rare false hits."""
    out, counts = lm(docs, F.lit(True))
    got = {r.row.doc_id: r.score for r in out.collect()}
    for d, exact in brute.lm_scores(pairs):
        assert abs(got[d] - exact) < 0.03 * abs(exact) + 0.05
    assert counts.means[lm_scoring.PAIR][1] == 1 and counts.means[lm_scoring.WORD][2] == 2


def test_lm_batches_and_ranges_do_not_matter(docs, lm, monkeypatch):
    whole = {r.row.doc_id: r for r in lm(docs)[0].collect()}
    monkeypatch.setattr(lm_scoring, "ASK_BYTES", 2000)
    monkeypatch.setattr(lm_scoring, "FLUSH_BYTES", 3000)
    monkeypatch.setattr(lm_scoring, "RANGE_TOKENS", 500)
    monkeypatch.setattr(lm_scoring, "FREQUENT", 50)
    cut, counts = lm(docs)
    assert counts.range_bits >= 3
    apart, rows = [], cut.collect()
    for r in rows:
        w = whole[r.row.doc_id]
        assert (r.n_tokens, r.n_known) == (w.n_tokens, w.n_known) and abs(r.base_score - w.base_score) < 1e-6 * max(1, abs(w.base_score))
        apart.append(abs(r.score - w.score) / r.n_tokens)
    assert np.mean(apart) < 0.1  # other ranges have other false hits: three in a thousand pairs, which these alike texts repeat


def test_lm_probabilities_sum_to_one(spark, lm):
    """Over all words, the end and one unknown word, behind every context of a small corpus."""
    from quantarium.session import Scratch

    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=40))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    counts = lm_scoring.count(df, F.lit(True), Scratch(spark, "sums"))
    levels = lm_scoring.look_up(df, counts, Scratch(spark, "sums"), {"doc_id": df.doc_id})
    table = lm_scoring.probabilities(counts, lm_scoring.tune(levels))
    ask = spark.createDataFrame([(c, w, f"{c} {w}") for c in vocabulary[:25] for w in [*vocabulary, "unknown"]], "c string, w string, text string")
    asked = lm_scoring.look_up(ask, counts, Scratch(spark, "sums"), {"c": ask.c, "w": ask.w})
    sums: dict = {}
    for x in asked.collect():
        cells, _ = lm_scoring._cells(pa.array([x.levels]))
        sums[x.row.c] = sums.get(x.row.c, 0) + table[cells[1]]
        if x.row.w == "w0":  # and the end, once a context
            ends = lm_scoring._cells(pa.array([x.levels]))[0]
            assert len(ends) == 3
    ends = spark.createDataFrame([(c, c) for c in vocabulary[:25]], "c string, text string")
    for x in lm_scoring.look_up(ends, counts, Scratch(spark, "sums"), {"c": ends.c}).collect():
        sums[x.row.c] += table[lm_scoring._cells(pa.array([x.levels]))[0][1]]
    assert len(sums) == 25 and all(abs(s - 1) < 0.1 for s in sums.values()) and abs(sum(sums.values()) / 25 - 1) < 0.02


def test_lm_twice_occurring_texts_stand_apart(spark, lm):
    """Texts that the corpus holds twice score higher a token than texts of the same words that it holds once or not."""
    r = random.Random(9)
    words = [f"v{i}" for i in range(3000)]
    rows = [(i, " ".join(r.choices(words, k=80))) for i in range(800)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    new = spark.createDataFrame([(5000 + i, " ".join(r.choices(words, k=80))) for i in range(40)], "doc_id long, text string")
    out, _ = lm(df.unionByName(new), F.col("doc_id") < 5000)
    a = {x.row.doc_id: x.score / x.n_tokens for x in out.collect()}
    twice, once, never = [a[i] for i in range(40)], [a[i] for i in range(100, 800)], [a[5000 + i] for i in range(40)]
    assert min(twice) > max(once) > max(never)


def test_lm_filter():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    counts = rng.integers(1, 400, 5000)
    f = lm_scoring.Filter.of(keys, counts)
    got, levels = f.levels(keys), lm_scoring.level_of(counts)
    assert (got >= levels).all() and (got > levels).mean() < 0.01  # errors only add
    assert (f.levels(keys + np.uint64(1)) > 0).mean() < 0.01
    head = lm_scoring.Filter.of(keys, counts, lm_scoring.HEAD_BITS, lm_scoring.HEAD_HASHES, 1)
    assert (head.levels(keys) == levels).all() and not head.levels(keys + np.uint64(1)).any()
    empty = lm_scoring.Filter.of(keys[:0], counts[:0])
    assert not empty.levels(keys).any()


def test_lm_memory_is_bounded():
    """What is broadcast: at most FREQUENT words and pairs at HEAD_BITS bits a level, and LEVELS cubed numbers."""
    worst = np.full(lm_scoring.FREQUENT, 1 << 40)
    keys = np.arange(1, lm_scoring.FREQUENT + 1, dtype=np.uint64)
    assert len(lm_scoring.Filter.of(keys, worst, lm_scoring.HEAD_BITS, lm_scoring.HEAD_HASHES, int(lm_scoring.level_of(np.array([1 << 24]))[0])).bits) < 20 << 20
    assert 8 * lm_scoring.LEVELS**3 <= 2 << 20


def test_token_prefix(texts, path):
    import sentencepiece

    model = path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    c = token_prefix.counter(model)
    for t in [*texts, "  a", "a  b ", "<s>x</s>", "▁a", "a▁▁b ", "ﬁ ①", "\x00"]:
        t = t or ""
        assert c.total(t) == len(library.encode(t))
        table = c.prefix_table(t)
        for i in sorted({0, 1, 2, len(t) // 2, max(len(t) - 1, 0), len(t)}):
            assert table.count(i) == len(library.encode(t[:i]))
        for budget in (0, 1, 7, 60):
            fit = c.fits(t, budget)
            assert fit == (table.fits(budget) if t else 0) and len(library.encode(t[:fit])) <= budget
            assert fit == len(t) or len(library.encode(t[: fit + 1])) > budget


def test_token_counts(docs, pairs, empty, path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    out = token_prefix.token_counts(docs, path("piece_bpe_32k.model"), budget=100)
    expected = sorted(((d, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 100) for d, t in pairs), key=repr)
    assert found(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert token_prefix.token_counts(empty, path("piece_bpe_32k.model")).count() == 0


def test_decontamination(spark, docs, pairs, empty, monkeypatch):
    items = [(1, pairs[0][1]), (1, "two words"), (2, prose(12, 120)[30:200]), (3, None), (None, "one"), (4, "..."), (10, "ONE"), (5, "not there at all anywhere")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 300):  # one block, and several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        f = decontaminate.find_passages(docs, bench, carry=["doc_id"])
        got = [(r.row.doc_id, r.n_words, r.n_hit, len(r.hit_items), decontaminate.item_digest(r.hit_items), r.n_hit > 0) for r in f.collect()]
        assert sorted(got, key=repr) == sorted(brute.decontamination(pairs, items), key=repr)
    assert decontaminate.find_passages(docs, bench.where("item_id > 99"), carry=["doc_id"]).where("n_hit > 0").count() == 0
    assert decontaminate.find_passages(empty, bench).count() == 0
    assert hashlib.sha256(b"").hexdigest() == decontaminate.item_digest([])


def test_fuzzy_containment(spark):
    item = " ".join(f"w{i}" for i in range(30))
    edited = item.replace("w15", "zz")
    docs = spark.createDataFrame([(1, "pre " + edited + " post"), (2, " ".join(f"w{i}" for i in range(10))), (3, "other text")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    whole = {r.row.doc_id: r.n_hit for r in decontaminate.find_passages(docs, bench, window=None, containment=0.8).collect()}
    assert whole == {1: 30, 2: 0, 3: 0}
    exact = {r.row.doc_id: r.n_hit for r in decontaminate.find_passages(docs, bench).collect()}
    assert exact == {1: 29, 2: 10, 3: 0}


def test_index_memory_and_speed():
    """Eight megabytes of benchmark text, a block: an index of ten times that, built in seconds."""
    import pickle
    import time

    r = np.random.default_rng(3)
    words = np.array([f"w{i:05d}" for i in range(50_000)])
    rows = [(str(i), " ".join(words[r.integers(0, len(words), 1000)])) for i in range(1200)]
    start = time.perf_counter()
    records = decontaminate.Records.of(rows, 10)
    counts = {k: (keys, np.arange(len(keys)) % 7) for k, keys in records.tables(5).items()}
    index = decontaminate.Index(records, counts, 5, 1.0)
    assert sum(len(t) for _, t in rows) > 8_000_000 and time.perf_counter() - start < 30
    assert len(pickle.dumps(index)) < 110 << 20
    assert len(records.first) == 1200 * 991


def test_bit_map_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BITMAP_BITS", 1 << 10)
    wanted = spark.range(0, 3000, 3).select(F.col("id").alias("u"), (F.col("id") + 30000).alias("v"))
    choose = near_duplicates._chooser(wanted, ("u", "v"))
    ids = near_duplicates._placed(spark.range(0, 6000).select("id", F.lit("t").alias("text"))).toArrow()
    kept = {x for b in ids.to_batches() for x in choose(b).column(0).to_pylist()}
    assert set(range(0, 3000, 3)) <= kept  # a full map keeps all and loses none


def test_language_against_restatement(spark):
    """Predictions and scores on texts with known, unseen and odd words; null ids, long texts, ties and extra columns among them."""
    r = random.Random(11)
    kinds = {"de": "haus wasser schiff und der die nicht".split(), "en": "house water ship and the not".split(), "fr": "maison eau bateau et le pas".split()}
    rows = [(i, " ".join(r.choices(kinds[x], k=r.randrange(1, 9))), x, "clash") for i, x in ((i, r.choice(list(kinds))) for i in range(120))]
    rows.append((None, "house house", "en", "clash"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    learnt = [(t, x) for d, t, x, _ in rows if d is None or zlib.crc32(str(d).encode()) % 4 != 2]
    texts = ["haus", "häuser und schiffe", "houses of watering", "bateaux", "zzz qqq", "", None, "12 ...", "the " * 3000 + "haus", "q"]
    asked = spark.createDataFrame([(None if i % 2 else i, t, str(i)) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    found = {x.row.lang_pred: (x.lang_pred, x.score) for x in language.identify(asked, language.train(df)).collect()}
    for i, (lang, score) in enumerate(brute.languages(learnt, texts)):
        assert found[str(i)][0] == lang and abs(found[str(i)][1] - score) < 1e-3
