"""A trie of conversations by their common first turns, from partial tries that merge by key.

Turns become two hashes and a word count at the scan; texts don't move. A prefix of d turns is told by its depth and by four sums of 32 bits
over its turns' hashes with their places (128 bits; sums of one conversation go on from range to range of the sorted turns, so a long
one isn't in one task). Each task combines its conversations' prefixes into a node table (members, smallest member); tables then
merge in rounds, FAN of them by key into one, until one is left, so a prefix that all conversations share costs a row a task.

Each node lies on the path of its smallest member. The rollup goes bottom up along these paths, as sums from the end of a conversation to its
start, and one more merge by node adds what the members bring: totals of subtrees without a round a level, however deep they are.
Lists of ends are merged by blocks of 4096 ids, and hashed block by block in order, so none is ever whole in memory.

Defined results: turns go by `turn`, null first, ties by a hash of role and text; repeated rows are repeated turns; null role or text is
empty; rows without conv_id belong to no conversation; an empty table has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantarium.operators.profile import running
from quantarium.session import Scratch, ship_package

#: Tables that one merge takes together.
FAN = 16
#: Bits of the ids of one block of ends.
BLOCK_BITS = 12
WORDS = r"[^\x20\x09-\x0D]+"
LOW = (1 << 32) - 1
KEY = ["depth", "k1", "k2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0) in the conversation, two hashes of role and text, and words of the text."""
    role, text = (F.coalesce(F.col(f"t.`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.alias("t").where(F.col("t.conv_id").isNotNull()).select(
        F.col("t.conv_id").cast("long").alias("conv_id"), F.col("t.turn").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    rows = running(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")], "words")
    starts = rows.groupBy("conv_id").agg(F.min("place").alias("start"))
    return rows.join(starts, "conv_id").select("conv_id", (F.col("place") - F.col("start")).alias("place"), "a", "b", "words")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count("*").alias("turns"))


def with_heads(turns: DataFrame, donor: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations whose first `taken` turns (at most `most`) are replaced by those of the conversation `donor`."""
    own = lengths(turns)
    given = F.least(F.col("h"), F.coalesce("lent", F.lit(0)))
    plan = own.withColumn("donor", donor).withColumn("h", taken).join(own.select(F.col("conv_id").alias("donor"), F.col("turns").alias("lent")), "donor", "left")
    plan = plan.select("conv_id", "donor", "h", given.alias("m"), (given + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("length"))
    heads = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "donor").join(plan.where("m > 0").select("conv_id", "donor", "m"), "donor").where("place < m")
    tails = turns.join(plan.select("conv_id", "h", "m"), "conv_id").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("m"))
    columns = ["conv_id", "place", "a", "b", "words"]
    return heads.select(*columns).unionByName(tails.select(*columns)), plan.select("conv_id", "length")


def prefixes(turns: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each conversation and depth from 0: its key, its parent's, words of the last turn, whether it ends there; `part` is the task's."""
    depth = (F.col("place") + 1).alias("depth")
    hashes = [F.xxhash64(F.lit(seed), "place", "a", "b") for seed in (11, 12)]
    pieces = [F.shiftrightunsigned(hashes[0], 32), hashes[0].bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(hashes[1], 32), hashes[1].bitwiseAND(F.lit(LOW))]
    # one scan of the sorted ranges adds all four sums
    rows = running_sums(turns.select("conv_id", depth, "words", *(p.alias(f"f{i}") for i, p in enumerate(pieces))), scratch)

    def keys(sums: list[Column]) -> list[Column]:
        return [F.shiftleft(sums[i], 32).bitwiseXOR(sums[i + 1]) for i in (0, 2)]

    now = keys([F.col(f"s{i}") for i in range(4)])
    before = keys([F.col(f"s{i}") - F.col(f"f{i}") for i in range(4)])
    rows = rows.join(sizes, "conv_id").select("conv_id", "depth", now[0].alias("k1"), now[1].alias("k2"), before[0].alias("p1"), before[1].alias("p2"), "words", (F.col("depth") == F.col("length")).alias("ends"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    roots = sizes.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("words"), (F.col("length") == 0).alias("ends"))
    return scratch.keep(rows.unionByName(roots).withColumn("part", F.spark_partition_id()), "prefixes")


def running_sums(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows with s0 to s3, the sums of f0 to f3 over their conversation up to them, itself included."""
    from pyspark.sql import Window

    ranged = scratch.keep(rows.repartitionByRange("conv_id", "depth").withColumn("part", F.spark_partition_id()), "ranged")
    # only a range's first conversation can have begun before it: one row a range, of those that begin inside none
    inside = ranged.groupBy("part", "conv_id").agg(*(F.sum(f"f{i}").alias(f"s{i}") for i in range(4)), F.min("depth").alias("first"))
    edges = inside.join(inside.where("first > 1").select("conv_id").distinct(), "conv_id", "left_semi")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = edges.select("part", "conv_id", *(F.coalesce(F.sum(f"s{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in range(4)))
    up_to = Window.partitionBy("part", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select("*", *(F.sum(f"f{i}").over(up_to).alias(f"s{i}") for i in range(4)))
    summed = summed.join(starts, ["part", "conv_id"], "left")
    return summed.select(*rows.columns, *((F.col(f"s{i}") + F.coalesce(f"b{i}", F.lit(0))).alias(f"s{i}") for i in range(4)))


def merged(tables: DataFrame, keys: list[str], how: dict[str, str], parts: int) -> DataFrame:
    """One table of `parts` partial ones (numbered by `part`): rounds of merges by key, FAN tables into one each."""
    aggregates = [getattr(F, f)(c).alias(c) for c, f in how.items()]
    while parts > FAN:
        parts = -(-parts // FAN)
        tables = tables.groupBy(*keys, F.floor(F.col("part") / FAN).cast("int").alias("part")).agg(*aggregates)
    return tables.groupBy(*keys).agg(*aggregates)


def build(turns: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """All nodes of the trie of ordered turns (conv_id, place, a, b, words) of conversations with these sizes (conv_id, length)."""
    ship_package(turns.sparkSession)
    rows = prefixes(turns, sizes, scratch)
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    rep = {"n_convs": "sum", "conv_id": "min", "p1": "min", "p2": "min", "words": "max"}
    nodes = scratch.keep(merged(rows.withColumn("n_convs", F.lit(1).cast("long")), KEY, rep, parts), "nodes")
    above = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(above, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    # along each conversation's own nodes, from its end: what lies at or below them
    own = running(nodes, [F.col("conv_id"), F.desc("depth")], "saved")
    paths = own.groupBy("conv_id").agg(
        F.min(F.col("up_to") - F.col("saved")).alias("before"), F.sum("saved").alias("brings"), F.min("depth").alias("top"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")
    )
    paths = scratch.keep(paths, "paths")
    brought = rows.select(*KEY, "conv_id", "part").join(paths.select("conv_id", "brings", "leaves"), "conv_id")
    brought = merged(brought, KEY, {"brings": "sum", "leaves": "sum"}, parts)
    # a node whose parent has another smallest member is the first of its conversation
    parents = nodes.select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    tops = own.select("conv_id", *KEY, "p1", "p2").join(paths.select("conv_id", F.col("top").alias("depth")), ["conv_id", "depth"])
    tops = tops.join(parents, ["depth", "p1", "p2"]).select("conv_id", "depth", "parent_conv_id")
    out = own.join(paths.select("conv_id", "before", F.col("brings").alias("all"), "top"), "conv_id").join(tops, ["conv_id", "depth"], "left").join(brought, KEY).join(ends(rows), KEY, "left")
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent_conv_id"))
    saved = F.col("brings") - F.col("all") + F.col("up_to") - F.col("before")
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def ends(rows: DataFrame) -> DataFrame:
    """Of each node at which conversations end, the SHA-256 of their ids in order, between commas."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    blocks = rows.where("ends").groupBy(*KEY, F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(ids.alias("ids"))
    blocks = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "ends_sha256"]
        key, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for *at, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if at == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = at, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names)

    return blocks.select(*KEY, "ids").mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the conversations as they are."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.keep(ordered_turns(conversations), "turns")
    return build(turns, lengths(turns).select("conv_id", F.col("turns").alias("length")), scratch)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    turns = scratch.keep(ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return build(*with_heads(turns, F.col("conv_id") - F.col("conv_id") % 20, taken, 3), scratch)
