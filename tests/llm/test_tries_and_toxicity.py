"""Toxicity, the trie of conversations and spelling variants: small awkward tables, and whole ones, against plain restatements."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantarium.llm import prefix_trie, registry, spelling, toxicity

# toxicity

RUDE = ["scumbag", "idiot", "moron"]


def speech(r: random.Random, n: int, rude: bool) -> str:
    words = [r.choice("stone river cloud paper green seven market winter horse table".split()) + r.choice(["", "s", "ly"]) for _ in range(n)]
    for _ in range(2 * rude):
        words.insert(r.randrange(n), r.choice(RUDE) + r.choice(["", "s", "ic"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def marked(spark):
    r = random.Random(3)
    rows = [(i, speech(r, r.randrange(5, 60), i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    docs = [(i, t, "x", 0.5) for i, t, _ in rows] + [(None, "idiot", "x", 0.5), (900, None, "x", 0.5), (901, "", "x", 0.5), (902, "stone river " * 30_000 + "moron scumbag", "x", 0.5), (903, "stone river " * 30_000, "x", 0.5), (0, rows[0][1], "x", 0.5)]
    labels = [(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (5, None, 1), (901, 0, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, row string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxicity_awkward(marked):
    docs, labels = marked
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).select("row.doc_id", "row.row", F.col("row.score").alias("carried"), "score").collect()
    assert len(out) == docs.count() and {r["row"] for r in out} == {"x"} and {r.carried for r in out} == {0.5}
    by = {r.doc_id: r.score for r in out}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((by[i] >= 0.5) == (i % 4 == 0) for i in held)
    assert by[902] >= 0.5 > by[903]  # one toxic end of a long text is enough
    base = 1 / (1 + np.exp(-model.intercept))
    assert by[900] == by[901] == pytest.approx(base)


def test_toxicity_learns_nothing_held_out(spark, marked):
    docs, labels = marked
    turned = labels.withColumn("toxic", F.when(toxicity.in_holdout(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert (a.grams == b.grams).all() and np.allclose(a.weights, b.weights) and a.intercept == pytest.approx(b.intercept)


def test_toxicity_restated(marked):
    """Features, ratios and the minimum of the loss, in plain Python."""
    docs, labels = marked
    mark = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id is not None}
    texts = {(r.text or "", mark[r.doc_id]) for r in docs.collect() if r.doc_id in mark and zlib.crc32(str(r.doc_id).encode()) % 5}
    weight = Counter(mark[r.doc_id] for r in labels.collect() if r.doc_id in mark and r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5)

    def grams(text):
        text = re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", f" {text.lower()} ") if text else ""
        return {text[i : i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)}

    found = [(grams(t), y) for t, y in sorted(texts)]
    size = Counter(y for _, y in found)
    counts = {y: Counter(g for gs, z in found if z == y for g in gs) for y in (0, 1)}
    ratio = {}
    for g in set(counts[0]) | set(counts[1]):
        p, q = counts[1][g] + 1, counts[0][g] + 1
        r = np.log(p / (size[1] + 2)) - np.log(q / (size[0] + 2))
        if abs(r) > toxicity.DEVIATIONS * np.sqrt(1 / p + 1 / q):
            ratio[g] = r
    model = toxicity.train(docs, labels)
    assert len(model.grams) == len(ratio)
    names = sorted(ratio)
    x = np.array([[ratio[g] * (g in gs) for g in names] for gs, _ in found])
    y = np.array([y for _, y in found])
    share = np.array([weight[v] / size[v] for v in y])
    share /= share.sum()
    w, ones = np.zeros(len(names) + 1), np.c_[x, np.ones(len(x))]
    penalty = toxicity.PENALTY * np.diag([1.0] * len(names) + [0.0])
    for _ in range(60):  # Newton's method on the whole matrix
        p = 1 / (1 + np.exp(-ones @ w))
        w -= 0.5 * np.linalg.solve(ones.T @ (ones * (share * p * (1 - p))[:, None]) + penalty + 1e-12 * np.eye(len(w)), ones.T @ (share * (p - y)) + penalty @ w)
    best = 1 / (1 + np.exp(-ones @ w))
    got = np.array([model.score(t) for t, _ in sorted(texts)])

    def loss(p):
        return -(share * np.log(np.where(y == 1, p, 1 - p))).sum()

    assert np.abs(got - best).max() < 0.05 and loss(got) < loss(best) + 0.005


def test_toxicity_one_label_or_none(spark, marked):
    docs, labels = marked
    clean = toxicity.train(docs, labels.where("toxic = 0"))
    assert len(clean.grams) == 0 and clean.score("idiot") < 1e-6
    none = toxicity.train(docs.where("doc_id < -5"), labels.where("doc_id < -5"))
    assert 0 <= none.score(None) <= 1 and toxicity.score(docs.where("doc_id < -5"), none).count() == 0


def test_long_text_in_pieces():
    text = " ".join(f"w{i * 7919 % 10007}" for i in range(90_000))
    points = toxicity.code_points(text)
    whole = np.unique(np.concatenate([toxicity.gram_hashes(points, n) for n in toxicity.SIZES]))
    assert len(points) > toxicity.PIECE and (toxicity.features(text) == whole).all()


def test_op11(spark, folder):
    out = registry.QUERIES["op11_toxicity"](spark, folder).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")
    assert len(out) == spark.read.parquet(f"{folder}/documents.parquet").count() and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.index]).all() and (out.predicted == (out.score >= 0.5)).all()
    both = labels.join(out, how="inner")
    assert both[both.toxic == 0].predicted.mean() < 0.05


# conversations

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def trie(built: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + ((len(nodes[k]) - 1) * len(WORDS.findall(k[-1][1])) if k else 0)
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def ordered(rows) -> dict[int, list[tuple[str, str]]]:
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [x for _, x in sorted(v, key=lambda x: x[0])] for c, v in out.items()}


def rebuilt(conversations: dict[int, list]) -> dict[int, list]:
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + own[h:]
    return out


def nodes(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def talks(spark):
    r = random.Random(11)
    rows = []
    for c in [*range(0, 70), 123_456, -3]:
        if c in (20, 40):
            continue  # absent donors
        for turn in range(r.randrange(1, 6)):
            rows.append((c, turn if turn else None, r.choice(["user", None]), r.choice(["a b", "a  b c\n", "", None, "x"])))
    rows += [(0, 50 + i, "user", f"long {i % 3}") for i in range(600)]  # most rows are of one conversation
    rows += [(4000 + i, 0, "user", "hello there") for i in range(100)] + [(4000 + i, 1, "bot", "same") for i in range(100)]
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    r.shuffle(rows)
    return spark.createDataFrame([(*x, "k", 7) for x in rows], "conv_id long, turn long, role string, text string, place string, words int").repartition(5).cache()


def test_trie_of_talks(talks):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in talks.collect()]
    assert nodes(prefix_trie.trie(talks)) == trie(ordered(rows))


def test_trie_rebuilt_and_merged_in_rounds(spark, talks, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FAN", 2)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    talks.write.parquet(str(tmp_path / "conversations.parquet"))
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in talks.collect()]
    got = registry.QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    # Spark's remainder is negative for negative ids, as SQL's
    want = {c: v for c, v in rebuilt({c: v for c, v in ordered(rows).items() if c >= 0}).items()}
    own = ordered(rows)[-3]
    h = zlib.crc32(b"-3") % 4
    want[-3] = ordered(rows).get(0, [])[:h] + own[h:]
    assert nodes(got) == trie(want)


def test_trie_ties_repeats_and_empty(spark, talks):
    schema = "conv_id long, turn long, role string, text string"
    twice = spark.createDataFrame([(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a"), (3, 5, "u", "b"), (3, 5, "u", "a"), (4, 5, "u", "a"), (4, 5, "u", "b")], schema)
    out = prefix_trie.trie(twice).toPandas()
    assert out[out.depth == 0].n_convs.tolist() == [4] and out[(out.conv_id == 1) & (out.depth == 2)].n_convs.tolist() == [1]
    assert out[(out.depth == 2) & (out.n_convs == 2)].conv_id.tolist() == [3]  # ties have one order, whatever that of the rows
    assert prefix_trie.trie(talks.where("conv_id < -50")).collect() == []
    assert prefix_trie.trie(talks.where("conv_id IS NULL")).collect() == []


def test_op12(spark, folder):
    source = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    df = registry.QUERIES["op12_prefix_trie"](spark, folder)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert nodes(df) == trie(rebuilt(ordered(map(tuple, source))))


# spelling


def variants(docs, least_count: int = 2) -> set[tuple]:
    counts: Counter = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return groups({w: n for w, n in counts.items() if n >= least_count})


def groups(words: dict[str, int]) -> set[tuple]:
    met = defaultdict(set)
    for w in words:
        met[w, ""].add(w)
        for k in range(len(w)):
            met[w[:k] + w[k + 1 :], ""].add(w)
            met[w[:k], w[k + 1 :], "one"].add(w)
    near = defaultdict(set)
    for key, members in met.items():
        for a in members:
            for b in members:
                if a != b and (len(key) == 3 or len(a) != len(b)):
                    near[a].add(b)
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("chars", [0, 30, 300, 1 << 30])
def test_spelling_at_any_cut(spark, chars):
    """However deep the trie is cut (0: at every word), the pairs are the same."""
    r = random.Random(chars)
    base = ["".join(r.choice("ab") for _ in range(r.randrange(1, 7))) for _ in range(60)] + ["prefixprefix" + "".join(r.choice("abé") for _ in range(r.randrange(0, 5))) for _ in range(80)]
    base += ["ÿ" * 40, "ÿ" * 41, "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499, "q"]
    words = {w: r.choice([2, 3, 20, 250, 2600]) for w in base}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert {tuple(x) for x in spelling.group(df, group_chars=chars).select(*COLUMNS).collect()} == groups(words)


def test_spelling_follows_forms(spark):
    words = {"aaaaaaaa": 1000, "aaaaaaab": 100, "aaaaaabb": 10, "aaaaabbb": 1, "zaaaaaab": 9}
    out = {r.word: r for r in spelling.group(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert out["aaaaabbb"].root == out["zaaaaaab"].root == "aaaaaaaa" and out["aaaaabbb"].form == "aaaaaabb"


def test_spelling_awkward_texts(spark):
    docs = [(1, "Mistake mistake MISTAKE mistakes mistakes Mistakés÷× mistakés÷×"), (2, None), (None, "mistake mistakés÷×"), (3, ""), (1, "Mistake mistake"), (4, "ſhort long-word x1x2x3 " + "verylongrun" * 9000), (5, "verylongrun" * 9000 + " tail")]
    df = spark.createDataFrame([(*d, "w", 3) for d in docs], "doc_id long, text string, word string, n int")
    got = spelling.group(spelling.vocabulary(df)).select(*COLUMNS)
    assert {tuple(x) for x in got.collect()} == variants(docs)
    assert spelling.group(spelling.vocabulary(df.where("doc_id < 0"))).collect() == []


def test_op13(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    df = registry.QUERIES["op13_spelling"](spark, folder)
    assert df.columns == COLUMNS and {tuple(x) for x in df.collect()} == variants(docs)
