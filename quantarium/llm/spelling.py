"""Spelling variants: words one edit apart, found by joining the vocabulary's trie with itself.

The trie is cut at nodes that hold at most GROUP_CHARS characters of words. Above the cut it is walked by Spark, a branching node at a
time: a node's active nodes at distance one are its children's siblings (a replaced character) and its children's children (an
inserted one), below which the rest must match exactly. So each word under such a node meets the others in a join on itself without
the character at that depth, whose groups have at most a word for each character of the alphabet. Paths without branches are jumped.
Below the cut a task holds one subtrie and carries each node's set of active nodes from that of its parent; pairs of terminals at
distance one come out. Two words meet at the node where they part and nowhere else, so each pair comes once from each side.
A prefix that many words share is cut deeper, and no task or group holds them all.

Words come from runs of letters, in lower case (A-Z only), counted by each task before the shuffle. A word's form is its near word with the
largest count (ties: the first in code-point order), if that is at least RATIO times its own; forms are followed to the last by
doubling, in at most a few rounds, as counts grow by RATIO with each step.

Defined results: null and empty texts have no runs; a null id counts as an empty one; repeated rows count again; without words the
result is empty; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantarium.llm import arrow_text
from quantarium.session import Scratch, ship_package

RUNS = re.compile("[a-zÀ-ÿ]+")
#: One run in so many loses a character.
SPOILED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: Characters of the words of one task's subtrie.
GROUP_CHARS = 24_000
#: Words that a task counts before it hands them on.
HELD_WORDS = 200_000


def runs(text: str | None) -> Counter:
    """Runs of letters with A-Z in lower case, and how often each occurs."""
    return Counter(RUNS.findall(text.encode().lower().decode())) if text else Counter()


def spoiled(doc_id: int | None, run: str, one_in: int = SPOILED) -> str:
    """The run, or without one character where the hash of id and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: the results of at least that length and count."""
    ship_package(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for run, n in runs(text).items():
                    if len(run) >= least_length and len(word := spoiled(doc_id, run)) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield table()
                    held.clear()
        yield table()

    counted = documents.select(documents[f"`{id_col}`"].alias("id"), documents[f"`{text_col}`"].alias("text")).mapInArrow(arrow_text.tidied(count), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def parting(a: F.Column, b: F.Column) -> F.Column:
    """Characters that two texts have in common at their start."""
    least = F.least(F.length(a), F.length(b))
    # the first place at which prefixes differ, by halving: ever longer texts need few steps more
    steps = F.sequence(F.lit(0), F.lit(30))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), least.alias("hi")), lambda s, _: _halved(a, b, s))
    return found["lo"]


def _halved(a: F.Column, b: F.Column, s: F.Column) -> F.Column:
    middle = F.shiftright(s["lo"] + s["hi"] + 1, 1)
    same = F.substring(a, F.lit(1), middle) == F.substring(b, F.lit(1), middle)
    return F.struct(F.when(same, middle).otherwise(s["lo"]).alias("lo"), F.when(same, s["hi"]).otherwise(F.greatest(s["lo"], middle - 1)).alias("hi"))


def near_words(words: DataFrame, scratch: Scratch, group_chars: int = GROUP_CHARS) -> DataFrame:
    """word, near, near_n: each pair of words (word, n; each word once) one edit apart, from both sides."""
    ship_package(words.sparkSession)
    left, turn, found = words.select("word", "n", F.lit(0).alias("depth")), 0, []
    while True:
        node = F.substring("word", F.lit(1), F.col("depth")).alias("node")
        nodes = left.groupBy("depth", node).agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("chars"), F.min("word").alias("least"), F.max("word").alias("most"))
        nodes = nodes.where("words > 1").select("depth", "node", (F.col("chars") > group_chars).alias("large"), F.when(F.col("chars") > group_chars, parting(F.col("least"), F.col("most"))).alias("cut"))
        marked = scratch.keep(left.select("word", "n", "depth", node).join(nodes, ["depth", "node"]), f"marked-{turn}")
        found.append(subtrie_pairs(marked.where("NOT large")))
        large = marked.where("large").select("word", "n", F.col("cut").alias("depth"))
        if large.isEmpty():
            break
        found.append(crossing_pairs(large))
        # words that end at the node have no child to go on in
        left, turn = large.where(F.length("word") > F.col("depth")).select("word", "n", (F.col("depth") + 1).alias("depth")), turn + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def crossing_pairs(words: DataFrame) -> DataFrame:
    """Pairs that part at the depth of the node that holds both: words met without their character there, or as they are."""
    end = F.length("word")
    without = F.concat(F.substring("word", F.lit(1), F.col("depth")), F.substring("word", F.col("depth") + 2, end))
    whole = F.struct(F.col("word").alias("key"), F.lit(True).alias("whole"))
    rows = words.select("word", "n", "depth", F.explode(F.when(end > F.col("depth"), F.array(F.struct(without.alias("key"), F.lit(False).alias("whole")), whole)).otherwise(F.array(whole))).alias("as"))
    # words with one key differ in one character at most, so a group has a word for each character of the alphabet and one more
    groups = rows.groupBy("depth", "as.key").agg(F.collect_list(F.struct("word", "n", "as.whole")).alias("members")).where(F.size("members") > 1)
    pairs = groups.select("depth", "members", F.explode("members").alias("a")).select("depth", "a", F.explode("members").alias("b"))
    after = [F.substring(f"{x}.word", F.col("depth") + 1, F.lit(1)) for x in "ab"]
    return pairs.where((F.col("a.word") != F.col("b.word")) & (after[0] != after[1])).select("a.word", F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))


def subtrie_pairs(words: DataFrame) -> DataFrame:
    """Pairs below a node, by a task for each."""

    def join(table: pa.Table) -> pa.Table:
        texts, n, depth = table["word"].to_pylist(), table["n"].to_pylist(), table["depth"][0].as_py()
        pairs = list(self_join([w[depth:] for w in texts]))
        return pa.table({"word": pa.array([texts[a] for a, _ in pairs], pa.string()), "near": pa.array([texts[b] for _, b in pairs], pa.string()), "near_n": pa.array([n[b] for _, b in pairs], pa.int64())})

    return words.groupBy("depth", "node").applyInArrow(arrow_text.tidied_group(join), "word string, near string, near_n long")


def self_join(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places (a, b) of distinct words one edit apart, from both sides, by a trie with a set of active nodes a node."""
    children: list[dict[str, int]] = [{}]
    above, ends = [0], [-1]
    for place, word in enumerate(words):
        at = 0
        for c in word:
            following = children[at].get(c)
            if following is None:
                following = children[at][c] = len(children)
                children.append({})
                above.append(at)
                ends.append(-1)
            at = following
        ends[at] = place

    def near(node: int, ones: set[int]) -> Iterator[tuple[int, int]]:
        if ends[node] >= 0:
            for m in ones:
                if ends[m] >= 0:
                    yield ends[node], ends[m]

    # the node itself is active at distance 0; `ones` are those at distance 1
    ones = set(children[0].values())
    yield from near(0, ones)
    waiting = [(0, ones)]
    while waiting:
        node, ones = waiting.pop()
        siblings = children[node]
        for c, child in siblings.items():
            # c deleted, c replaced, one more character inserted; or c again after an edit
            active = {node, *siblings.values(), *children[child].values()}
            active.discard(child)
            for m in ones:
                following = children[m].get(c)
                if following is not None and following != child:
                    active.add(following)
            yield from near(child, active)
            waiting.append((child, active))


def group(words: DataFrame, ratio: int = RATIO, group_chars: int = GROUP_CHARS) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word (word, n)."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.keep(words, "words")
    near = near_words(words, scratch, group_chars).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    rows = words.join(near, "word", "left")
    form = -F.col("best.n") >= ratio * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, F.col("best.near")).alias("form"), F.when(form, -F.col("best.n")).alias("form_n"))
    rows = scratch.keep(rows, "forms")
    steps, turn = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = scratch.keep(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"steps-{turn}")
        if not steps.agg(F.bool_or("moved")).first()[0]:
            break
        steps, turn = steps.select("word", "root"), turn + 1
    return rows.join(steps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("word", "form", "root", "n", "n_near", "form_n")
