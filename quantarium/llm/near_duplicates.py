"""MinHash near-duplicates: many universal hash minima, banding, signatures, full sets, components.

Texts become sets of word shingles; equal sets are one group, of which one member goes on. Each set
keeps the minima of many multiply-shift hashes; runs of ROWS minima form bands, and as many bands
are used as make the chance to miss a pair at the threshold at most MISS. Sets that share a band are
a bucket. Candidates come in two turns, neither of which pairs up a bucket:

1. A bucket's members are compared with its most popular member only (whose bands fall into the
   largest buckets in all: the original of its copies). Pairs whose signatures agree too little for
   the threshold (binomial tail below 1e-9) go; the rest is confirmed on full sets of the texts.
2. The buckets of one such member form a group; groups that still hold several components are
   compared across components, block against block in numpy: by set sizes, by signatures, and on
   full sets. Only links that join components are rows.

So a large group of copies costs a row for each member, and no link between different sets that
share a band is lost. Confirmed links become components by alternating large-star and small-star.

Only ids that are candidates have their texts joined; a bit map of fixed size (BITMAP_BITS) sorts
out the others before the shuffle, whatever their number; its false hits only cost shuffle.

Ids are numbers that fit into 64 bits, or texts of such numbers; others fail the job.

Defined results: null texts and texts without words are empty sets, linked with nothing; a text of
fewer words than a shingle is one shingle; repeated rows fall into one component; rows of one id
with different texts are one node; a null id is its own component and is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantarium.llm import arrow_text
from quantarium.llm.arrow_text import LOWER, WHITE, U, mix
from quantarium.operators.graph import components
from quantarium.session import Scratch, ship_package

SHINGLE = 5
PERCENT = 80
ROWS = 5
MISS = 1e-7
#: Members of a group that are compared at once in the second turn.
BLOCK = 1024
BITMAP_BITS = 1 << 25
PARTS = 64


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def least_agreement(hashes: int, percent: int, miss: float = 1e-9) -> int:
    """The most minima that a pair at the threshold agrees on but for a chance of `miss`."""
    p, total = percent / 100, 0.0
    for k in range(hashes + 1):
        total += math.comb(hashes, k) * p**k * (1 - p) ** (hashes - k)
        if total > miss:
            return k
    return hashes


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draws = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 63, (2, hashes), dtype=np.uint64)
    return draws[0] * U(2) + U(1), draws[1]


def sketch(documents: DataFrame, shingle: int, hashes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, s1, s2 (a 128-bit hash of the set) and signature (little-endian minima) of each row."""
    ship_package(documents.sparkSession)
    a, b = _coefficients(hashes)

    def run(batches):
        for batch in batches:
            offsets, data = arrow_text.buffers(batch.column(1))
            sizes, ones, twos, signs = [], [], [], []
            for lo, hi in arrow_text.chunks(offsets):
                own = LOWER[data[offsets[lo] : offsets[hi]]]
                starts, ends, first = arrow_text.word_spans(own, offsets[lo : hi + 1] - offsets[lo], WHITE)
                grams, rows = arrow_text.shingle_hashes(arrow_text.span_hashes(own, starts, ends), first, shingle)
                where = np.searchsorted(rows, np.arange(hi - lo + 1))
                distinct = [np.unique(grams[i:j]) for i, j in zip(where, where[1:])]
                n = np.fromiter(map(len, distinct), np.int64, hi - lo)
                full = np.flatnonzero(n)
                minima = np.zeros((hi - lo, hashes), dtype="<u4")
                s1, s2 = np.zeros(hi - lo, dtype=np.uint64), np.zeros(hi - lo, dtype=np.uint64)
                if len(full):
                    values = np.concatenate([distinct[i] for i in full])
                    begins = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                    s1[full] = mix(np.add.reduceat(mix(values ^ U(1)), begins))
                    s2[full] = mix(np.add.reduceat(mix(values ^ U(2)), begins))
                    room = np.empty_like(values)
                    for j in range(hashes):
                        np.multiply(values, a[j], out=room)
                        np.add(room, b[j], out=room)
                        minima[full, j] = np.minimum.reduceat(room, begins) >> U(32)  # the shift keeps the order
                sizes.append(n)
                ones.append(s1.view(np.int64))
                twos.append(s2.view(np.int64))
                signs += [minima[i].tobytes() if n[i] else None for i in range(hi - lo)]
            join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(join(sizes)), pa.array(join(ones)), pa.array(join(twos)), pa.array(signs, pa.binary())], ["id", "n_shingles", "s1", "s2", "signature"])

    rows = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    return rows.mapInArrow(arrow_text.tidied(run), "id long, n_shingles long, s1 long, s2 long, signature binary")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x, dtype="<u4") for x in column.to_pylist()], dtype=np.uint32)


def _band_rows(groups: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, rep): the hash of each of a set's bands."""
    steps = mix(np.arange(1, rows + 1, dtype=np.uint64) + U(77)) | U(1)
    salt = mix(np.arange(bands, dtype=np.uint64) + U(1234))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            s = _signatures(batch.column(1)).astype(np.uint64).reshape(-1, bands, rows)
            keys = mix((s * steps).sum(axis=2, dtype=np.uint64) ^ salt)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands))], ["band", "rep"])

    return groups.select("rep", "signature").mapInArrow(arrow_text.tidied(run), "band long, rep long")


def _agreeing(pairs: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """The pairs (u, v) whose signatures agree on at least so many minima."""
    own = groups.select("rep", "signature")
    both = pairs.join(own.toDF("u", "su"), "u").join(own.toDF("v", "sv"), "v").select("u", "v", "su", "sv")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                same = (_signatures(batch.column(2)) == _signatures(batch.column(3))).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(same))

    return both.mapInArrow(arrow_text.tidied(run), "u long, v long")


def _shingles(text: str | None, k: int) -> set:
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < k else set(zip(*(words[i:] for i in range(k))))


def _placed(ids: DataFrame) -> DataFrame:
    return ids.withColumn("bit", F.pmod(F.xxhash64("id"), F.lit(BITMAP_BITS)))


def _chooser(wanted: DataFrame, names: tuple[str, ...]):
    """A function that keeps of a batch (id, text, bit) the rows whose bit is set by an id of `wanted`: all that are there and few others.

    Tasks send words of 64 bits or-ed together, so that no more than BITMAP_BITS / 64 of them come
    from a task or reach the driver, however many ids there are.
    """
    ids = _placed(wanted.select(F.explode(F.array(*names)).alias("id")))
    words = ids.select(F.expr("bit div 64").alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    held[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    shared = wanted.sparkSession.sparkContext.broadcast(held)

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        bit = batch.column(2).to_numpy(zero_copy_only=False)
        hit = (shared.value[bit >> 6] >> (bit & 63)) & 1 == 1
        return batch.select([0, 1]).filter(pa.array(hit & batch.column(0).is_valid().to_numpy(zero_copy_only=False)))

    return choose


def _picked(documents: DataFrame, wanted: DataFrame, names: tuple[str, ...]) -> DataFrame:
    choose = _chooser(wanted, names)

    def pick(batches):
        for batch in batches:
            yield choose(batch)

    return _placed(documents).mapInArrow(arrow_text.tidied(pick), "id long, text string")


def _confirmed(pairs: DataFrame, documents: DataFrame, scratch: Scratch, name: str, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold; documents are (id, text)."""
    pairs = scratch.keep(pairs, f"{name}-pairs")
    texts = scratch.keep(_picked(documents, pairs, ("u", "v")), f"{name}-texts")
    both = pairs.join(texts.toDF("v", "tv"), "v").join(texts.toDF("u", "tu"), "u").select("u", "v", "tu", "tv")

    def run(batches):
        last, held = None, set()
        for batch in batches:
            u, v, tu, tv = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(u)):
                if last != tu[i]:
                    last, held = tu[i], _shingles(tu[i], shingle)
                other = _shingles(tv[i], shingle)
                shared = len(held & other)
                keep.append(100 * shared >= percent * (len(held) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    links = scratch.keep(both.mapInArrow(arrow_text.tidied(run), "u long, v long").distinct(), f"{name}-links")
    scratch.drop(f"{name}-texts")
    return links


def _sets(documents: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rep, set): the ordered 64-bit hashes of the shingles of each wanted id's texts."""

    choose = _chooser(wanted, ("rep",))

    def run(batches):
        for batch in map(choose, batches):
            offsets, data = arrow_text.buffers(batch.column(1))
            sets = []
            for lo, hi in arrow_text.chunks(offsets):
                own = LOWER[data[offsets[lo] : offsets[hi]]]
                starts, ends, first = arrow_text.word_spans(own, offsets[lo : hi + 1] - offsets[lo], WHITE)
                grams, rows = arrow_text.shingle_hashes(arrow_text.span_hashes(own, starts, ends), first, shingle)
                where = np.searchsorted(rows, np.arange(hi - lo + 1))
                sets += [np.unique(grams[i:j]).tobytes() for i, j in zip(where, where[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "set"])

    return _placed(documents).mapInArrow(arrow_text.tidied(run), "rep long, set binary").join(wanted, "rep", "left_semi")


def _across(members: DataFrame, groups: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """Links (u, v) that join components inside a group; members are (center, rep, root, n).

    Links are confirmed on the spot, and one that joins nothing new in its task is no row.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep", "center"), F.col("blocks")).cast("int"))
    # each member meets every block: as (lower, higher) block numbers
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("center", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "root")
    rows = rows.join(groups.select("rep", "signature"), "rep").join(sets, "rep")

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own, rep, root = (table.column(c).to_numpy() for c in ("own", "rep", "root"))
        signs = _signatures(table.column("signature"))
        full = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        size = np.fromiter(map(len, full), np.int64, len(full))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        upper: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := upper.get(x, x)) != x:
                upper[x] = x = upper.get(y, y)
            return x

        us, vs = [], []
        for k in left:
            near = right[(root[right] != root[k]) & ((rep[right] > rep[k]) | (i != j))]
            near = near[100 * np.minimum(size[near], size[k]) >= percent * np.maximum(size[near], size[k])]
            near = near[(signs[near] == signs[k]).sum(axis=1) >= least]
            for x in near:
                a, b = top(int(root[k])), top(int(root[x]))
                if a == b:
                    continue
                shared = len(np.intersect1d(full[k], full[x], assume_unique=True))
                if 100 * shared >= percent * (size[k] + size[x] - shared):
                    upper[max(a, b)] = min(a, b)
                    us.append(max(rep[k], rep[x]))
                    vs.append(min(rep[k], rep[x]))
        return pa.table([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return rows.groupBy("center", "i", "j").applyInArrow(arrow_text.tidied_group(compare), "u long, v long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept of each row; links have at least percent % of shingles in common."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    bands = bands_for(percent)
    least = least_agreement(bands * ROWS, percent)
    texts = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    sketches = scratch.keep(sketch(documents, shingle, bands * ROWS, id_col, text_col), "sketches")
    usable = sketches.where("id IS NOT NULL AND n_shingles > 0")
    groups = scratch.keep(usable.groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.first("signature").alias("signature")), "groups")

    rows = scratch.keep(_band_rows(groups, bands, ROWS), "bands")
    counts = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = scratch.keep(rows.join(counts, "band"), "shared")
    scratch.drop("bands")
    popular = shared.groupBy("rep").agg(F.sum("n").alias("popularity"))
    centers = shared.join(popular, "rep").groupBy("band").agg(F.max_by("rep", F.struct("popularity", (-F.col("rep")).alias("order"))).alias("center"))
    centers = scratch.keep(centers, "centers")
    pairs = shared.join(centers, "band").where("rep <> center").select(F.greatest("rep", "center").alias("u"), F.least("rep", "center").alias("v")).distinct()
    first = _confirmed(_agreeing(pairs, groups, least), texts, scratch, "first", shingle, percent)

    # rows of one id with different texts are one node
    own = usable.join(groups.select("s1", "s2", "rep"), ["s1", "s2"]).select("id", "rep")
    split = own.groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("u")).where("u <> v")
    twice = own.join(split.select("id"), "id").select(F.col("id").alias("u"), F.col("rep").alias("v")).where("u <> v")
    links = scratch.keep(first.unionByName(twice), "links")
    roots = scratch.keep(components(links, scratch, "stars"), "roots")

    placed = shared.join(centers, "band").select("center", "rep").distinct().join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    placed = scratch.keep(placed.select("center", "rep", F.coalesce("root", "rep").alias("root")), "placed")
    mixed = placed.groupBy("center").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low <> high").select("center", "n")
    # a group may hold any share of the rows: its members are dealt over PARTS tasks
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(PARTS)))
    copies = mixed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    members = scratch.keep(dealt.join(copies, ["center", "part"]).drop("part"), "members")
    second = scratch.keep(_across(members, groups, _sets(texts, members.select("rep").distinct(), shingle), least, percent), "second")
    if not second.isEmpty():
        joined = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(second)
        roots = scratch.keep(components(joined, scratch, "more-stars"), "more-roots")

    out = sketches.join(groups.select("s1", "s2", "rep"), ["s1", "s2"], "left")
    rep = F.when(F.col("n_shingles") > 0, F.coalesce("rep", "id")).otherwise(F.col("id"))
    out = out.select("id", "n_shingles", rep.alias("rep")).join(roots.toDF("rep", "root"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "rep"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85)
