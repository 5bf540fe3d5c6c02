"""Packing: cutting-stock column generation over the histogram of piece lengths.

A document's ids are cut at multiples of the capacity: whole pieces fill a sequence each, the rest
of a document is one shorter piece. The lengths of those, rounded up to a grain, form a histogram
of at most capacity / grain classes whatever the number of documents; only it reaches the driver.
There a linear program (revised simplex) covers the histogram with the fewest sequences; its
columns are patterns (how many pieces of each class share a sequence), priced by a knapsack dynamic
program over the dual values, until Farley's bound shows the program is solved to `tolerance`.
Patterns are used their rounded-down number of times; the few pieces that remain are laid by first
fit decreasing. Pieces are ranked within their class, by counts of (class, salt) groups and row
numbers inside these, and rank decides pattern, sequence and slot.

Defined results: null and empty texts are documents of the end id alone; a repeated row is packed
once for each time; a null id is kept; an empty table gives an empty result; columns beyond id and
text are ignored.
"""

from __future__ import annotations

import warnings
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantarium.llm.arrow_text import tidied
from quantarium.llm.byte_pair import encoder
from quantarium.session import Scratch, ship_package

CAPACITY = 2048
END_ID = 1
#: Lengths are classed by multiples of this; the linear program has capacity / GRAIN rows.
GRAIN = 4
#: Rows that one (class, salt) group should have at most when ranks are given.
GROUP_ROWS = 200_000


def knapsack(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best value and item numbers; item i (0-based) weighs i + 1 and may be used repeatedly."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        n = min(c, len(values))
        total = best[c - n : c][::-1] + values[:n]
        i = int(total.argmax())
        if total[i] > best[c - 1]:
            best[c], took[c] = total[i], i + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(len(values), dtype=np.int64), capacity
    while c > 0:
        if took[c]:
            counts[took[c] - 1] += 1
            c -= took[c]
        else:
            c -= 1
    return float(best[capacity]), counts


@dataclass(frozen=True)
class Solution:
    patterns: np.ndarray  # columns: pieces of each class
    uses: np.ndarray  # how often the linear program uses each
    bound: float  # no packing of the histogram has fewer sequences
    rounds: int
    gap: float  # share of sequences above the bound that the program may have


def solve(demand: np.ndarray, capacity: int, tolerance: float = 1e-3, rounds: int = 6_000) -> Solution:
    """Column generation for the fewest sequences; demand[i] pieces weigh i + 1 of capacity.

    Warns with the gap that is left if the rounds run out before it is below the tolerance.
    """
    classes = np.flatnonzero(demand)
    m = len(classes)
    if not m:
        return Solution(np.zeros((len(demand), 0), dtype=np.int64), np.zeros(0), 0.0, 0, 0.0)
    d = demand[classes].astype(float)
    single = capacity // (classes + 1)
    basis = np.diag(single).astype(float)
    inverse = np.diag(1.0 / single)
    cost = np.ones(m)
    x = inverse @ d
    bound = float(d @ (classes + 1)) / capacity  # the volume; Farley's bound may raise it
    done = 0
    for done in range(1, rounds + 1):  # noqa: B007
        dual = np.einsum("i,ij->j", cost, inverse)  # einsum: small products gain nothing from threads
        entering_cost = 1.0
        if dual.min() < -1e-9:  # a surplus column helps more than any pattern
            column = np.zeros(m)
            column[int(dual.argmin())] = -1.0
            entering_cost = 0.0
        else:
            values = np.full(len(demand), -1.0)
            values[classes] = np.maximum(dual, 0)
            value, counts = knapsack(values, capacity)
            bound = max(bound, float(dual @ d) / max(value, 1.0))
            if value <= 1 + 1e-9 or float(cost @ x) <= bound * (1 + tolerance):
                break
            column = counts[classes].astype(float)
        step = np.einsum("ij,j->i", inverse, column)
        up = step > 1e-9
        if not up.any():
            break
        ratios = np.full(m, np.inf)
        ratios[up] = np.maximum(x[up], 0) / step[up]
        r = int(ratios.argmin())
        basis[:, r], cost[r] = column, entering_cost
        x = x - ratios[r] * step
        x[r] = ratios[r]
        row = inverse[r] / step[r]
        inverse = inverse - np.outer(step, row)
        inverse[r] = row
        if done % 200 == 0 and np.abs(np.einsum("ij,j->i", basis, x) - d).max() > 1e-6 * (1 + d.max()):
            inverse = np.linalg.inv(basis)
            x = np.einsum("ij,j->i", inverse, d)
    gap = max(0.0, float(cost @ x) / bound - 1)
    if done == rounds and gap > tolerance:
        warnings.warn(f"the packing program stopped after {rounds} rounds with a gap of {gap:.2%}", stacklevel=2)
    used = (cost > 0) & (x > 1e-9)
    patterns = np.zeros((len(demand), int(used.sum())), dtype=np.int64)
    patterns[classes] = np.rint(basis[:, used]).astype(np.int64)
    return Solution(patterns, x[used], bound, done, gap)


def first_fit(demand: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """First fit decreasing of the pieces left by rounding; a dict of class counts for each sequence."""
    room: list[int] = []
    bins: list[dict[int, int]] = []
    for c in np.flatnonzero(demand)[::-1]:
        weight, left, b = int(c) + 1, int(demand[c]), 0
        while left:
            while b < len(room) and room[b] < weight:
                b += 1
            if b == len(room):
                room.append(capacity)
                bins.append({})
            n = min(left, room[b] // weight)
            room[b] -= n * weight
            bins[b][int(c)] = bins[b].get(int(c), 0) + n
            left -= n
    return bins


@dataclass(frozen=True)
class Assignment:
    """Segments of ranks: a piece of `kind` with from <= rank < next from goes to sequence base + (rank - from) // slots."""

    kinds: np.ndarray
    froms: np.ndarray
    slots: np.ndarray
    bases: np.ndarray
    sequences: int

    def sequence(self, kind: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.empty(len(kind), dtype=np.int64)
        for k in np.unique(kind):
            mine, at = np.flatnonzero(self.kinds == k), kind == k
            j = mine[np.searchsorted(self.froms[mine], rank[at], "right") - 1]
            out[at] = self.bases[j] + (rank[at] - self.froms[j]) // self.slots[j]
        return out


def assign(demand: np.ndarray, capacity: int) -> Assignment:
    """Patterns of the linear program and of first fit as segments of ranks."""
    solution = solve(demand, capacity)
    taken = np.zeros(len(demand), dtype=np.int64)
    rows: list[tuple[int, int, int, int]] = []
    base = 0

    def lay(counts: dict[int, int], times: int) -> None:
        nonlocal base
        laid = False
        for c, n in counts.items():
            if taken[c] < demand[c]:
                rows.append((c, int(taken[c]), n, base))
                taken[c] = min(demand[c], taken[c] + n * times)
                laid = True
        base += times * laid

    for p, times in zip(solution.patterns.T, np.floor(solution.uses + 1e-6).astype(int)):
        if times:
            lay({int(c): int(p[c]) for c in np.flatnonzero(p)}, int(times))
    for counts in first_fit(demand - taken, capacity):
        lay(counts, 1)
    rows.sort()
    a = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return Assignment(a[:, 0], a[:, 1], a[:, 2], a[:, 3], base)


def cut_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens and, if asked for, ids (array) of each piece."""
    ship_package(documents.sparkSession)
    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        encode = encoder(tokenizer_path)
        for batch in batches:
            rows, starts, lengths, sums, totals, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = encode.ids(text or "") + end
                n = len(own) // 4
                for start in range(0, n, capacity):
                    piece = own[4 * start : 4 * (start + capacity)]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, dtype="<i4"))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        encode.held.clear()

    return documents.select(documents[id_col].alias("id"), documents[text_col].alias("text")).mapInArrow(tidied(cut), schema)


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset there (columns of cut_documents besides)."""
    spark = documents.sparkSession
    grain = GRAIN if capacity % GRAIN == 0 else 1
    scratch = Scratch(spark, "packing")
    pieces = cut_documents(documents, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    kind = F.when(F.col("length") == capacity, F.lit(-1)).otherwise(F.floor((F.col("length") - 1) / grain)).cast("long")
    pieces = scratch.keep(pieces.withColumn("kind", kind), "pieces")

    # one small pre-aggregated table of at most classes x salts rows gives ranks their starts
    rows = pieces.count()
    salts = max(8, -(-rows // GROUP_ROWS))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "start"), F.lit(salts)))
    sizes = scratch.keep(pieces.groupBy("kind", "salt").count(), "sizes")
    starts = sizes.withColumn("before", F.sum("count").over(Window.partitionBy("kind").orderBy("salt")) - F.col("count")).drop("count")
    histogram = {r["kind"]: r["n"] for r in sizes.groupBy("kind").agg(F.sum("count").alias("n")).collect()}  # at most capacity / grain + 1 rows
    demand = np.zeros(capacity // grain, dtype=np.int64)
    for k, n in histogram.items():
        if k >= 0:
            demand[k] = n
    plan = assign(demand, capacity // grain)

    inside = Window.partitionBy("kind", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = pieces.withColumn("inside", F.row_number().over(inside)).join(starts, ["kind", "salt"])
    ranked = ranked.withColumn("rank", F.col("inside") - 1 + F.col("before")).drop("inside", "before", "salt")
    names = [c for c in ranked.columns if c not in ("kind", "rank")]
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name in names)

    def place(batches):
        for batch in batches:
            k, r = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "rank"))
            full = k < 0
            sequence = np.where(full, plan.sequences + r, 0)
            if not full.all():
                sequence[~full] = plan.sequence(k[~full], r[~full])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence, pa.int64())], [*names, "sequence_id"])

    placed = ranked.mapInArrow(place, f"{out}, sequence_id long")
    beside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "id", "start", "ids_crc32", "doc_tokens")
    placed = placed.withColumn("offset", F.sum("length").over(beside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
    order = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return placed.select(*order).withColumnRenamed("id", id_col)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
