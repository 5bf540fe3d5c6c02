"""Benchmark decontamination: a prefix-filtered set join of documents with benchmark windows.

A record is a window of consecutive words of a benchmark item (the whole item if shorter), seen as
its set of word shingles. One pass over the documents counts how often each benchmark shingle
occurs in the corpus; a record's shingles are ordered by that rarity. To share `need` of its S
shingles a text must have one of the S - need + 1 rarest, so only these are looked up at each
position of a text (a 64-bit hash, behind a table of its low bits). A find gives the range where
an item-sized window of the text may start, cut by the text's length (length bound) and by the
shingle's place in the record (positional bound); the window is then verified: by its words for
containment 1, else by counting the record's shingles in it.

The benchmark's records go to the workers in blocks of at most BLOCK_BYTES of item text; further
blocks are further passes in the same stage over the rows, so what is broadcast is an index of
arrays of at most some ten times BLOCK_BYTES, and no row is shuffled.

Defined results: null or wordless texts have no words and no hits; benchmark rows without id, text
or words are no items, rows of one id are one item; repeated documents each get their row; an empty
benchmark hits nothing; words are compared as bytes after A-Z became a-z.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quantarium.llm import arrow_text
from quantarium.llm.arrow_text import LOWER, NOT_ALNUM, U, mix
from quantarium.session import ship_package

WINDOW = 10
SHINGLE = 5
#: Item text in one block of records, whose index takes some ten times as much memory.
BLOCK_BYTES = 8 << 20
_LOW = 18


def words_of(column: pa.Array, lo: int, hi: int, offsets: np.ndarray, data: np.ndarray):
    """Lower-cased bytes, spans, hashes and first words of rows lo to hi."""
    own = LOWER[data[offsets[lo] : offsets[hi]]]
    starts, ends, first = arrow_text.word_spans(own, offsets[lo : hi + 1] - offsets[lo], NOT_ALNUM)
    return own, starts, ends, arrow_text.span_hashes(own, starts, ends), first


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each position; the last k - 1 positions have none."""
    n = max(len(words) - k + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += words[j : j + n] * arrow_text._STEPS[j]
    return mix(out ^ U(k))


def window_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of the words in each window, from sums over all words: the same wherever the window stands."""
    powers, inverse = arrow_text._powers(max(19, len(words).bit_length()))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * inverse[starts] + lengths.astype(np.uint64))


@dataclass
class Records:
    """The words of items, one after the other, and the windows that are records, as numbers of first words."""

    items: list[str]
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    #: Of each word, the word behind its item's last.
    last: np.ndarray
    first: np.ndarray
    length: np.ndarray
    item: np.ndarray
    whole: np.ndarray

    @staticmethod
    def of(rows: list[tuple[str, str]], window: int | None) -> Records:
        names = sorted({item for item, _ in rows})
        number = {item: i for i, item in enumerate(names)}
        column = pa.array([text for _, text in rows], pa.large_string())
        offsets, data = arrow_text.buffers(column)
        own, starts, ends, hashes, sizes = [data[:0]], [], [], [], []
        for lo, hi in arrow_text.chunks(offsets):
            part, a, b, h, first = words_of(column, lo, hi, offsets, data)
            own.append(part)
            starts.append(a + offsets[lo])
            ends.append(b + offsets[lo])
            hashes.append(h)
            sizes.append(np.diff(first))
        join = lambda x, t: np.concatenate([*x, np.zeros(0, t)]).astype(t)
        starts, ends, hashes, n = join(starts, np.int32), join(ends, np.int32), join(hashes, np.uint64), join(sizes, np.int64)
        begins = np.concatenate([[0], np.cumsum(n)])
        size = np.minimum(window or n, n)
        times = np.where(n > 0, n - size + 1, 0)
        row = np.repeat(np.arange(len(n)), times)
        first = begins[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        item = np.array([number[i] for i, _ in rows], dtype=np.int64)[row] if rows else row
        whole = window_hashes(hashes, first, size[row])
        order = np.lexsort((first, whole, item))  # an item's equal windows are one record
        new = np.ones(len(order), dtype=bool)
        new[1:] = (item[order][1:] != item[order][:-1]) | (whole[order][1:] != whole[order][:-1])
        keep = np.sort(order[new])
        return Records(names, np.concatenate(own), starts, ends, hashes, np.repeat(begins[1:], n).astype(np.int32), first[keep].astype(np.int32), size[row][keep].astype(np.int32), item[keep].astype(np.int32), whole[keep])

    def shingles(self, r: int, k: int) -> np.ndarray:
        return grams(self.hashes[self.first[r] : self.first[r] + self.length[r]], k)

    def text(self, r: int) -> bytes:
        at = slice(self.first[r], self.first[r] + self.length[r])
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[at], self.ends[at]))

    def tables(self, shingle: int) -> dict[int, np.ndarray]:
        """By number of words, the ordered hashes of all records' shingles."""
        out = {}
        k_of = np.minimum(self.length, shingle)
        for k in np.unique(k_of):
            own = np.zeros(len(self.hashes) + 1, dtype=np.int64)  # covered places, by where records begin and end
            np.add.at(own, self.first[k_of == k], 1)
            np.add.at(own, (self.first + self.length - k + 1)[k_of == k], -1)
            out[int(k)] = np.unique(grams(self.hashes, int(k))[np.cumsum(own)[: len(self.hashes) - k + 1] > 0])
        return out


@dataclass
class Prefixes:
    """Of records of one shingle size: the keys of their rarest shingles, and each key's records and places."""

    keys: np.ndarray
    low: np.ndarray
    begins: np.ndarray
    record: np.ndarray
    place: np.ndarray


class Index:
    """The prefix shingles of records, and the verification of what they find: arrays of 60 bytes a word in all."""

    def __init__(self, records: Records, counts: dict[int, tuple[np.ndarray, np.ndarray]], shingle: int, containment: float):
        """counts: by shingle size, ordered hashes and their numbers in the documents."""
        self.records, self.shingle, self.containment = records, shingle, containment
        self.exact = containment >= 1
        self.need = np.zeros(len(records.first), dtype=np.int32)
        self.sizes: dict[int, Prefixes] = {}
        k_of = np.minimum(records.length, shingle)
        for k in map(int, np.unique(k_of)):
            keys, n = counts[k]
            rank = np.empty(len(keys), dtype=np.int64)
            rank[np.lexsort((keys, n))] = np.arange(len(keys))
            by_rank = keys[np.argsort(rank)]
            own = grams(records.hashes, k)
            found: list[tuple] = []
            for length in np.unique(records.length[k_of == k]):
                rows = np.flatnonzero((k_of == k) & (records.length == length))
                width = int(length) - k + 1
                step = max(1, (1 << 20) // width)
                for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                    ranks = rank[np.searchsorted(keys, own[records.first[part][:, None] + np.arange(width)])]
                    order = np.argsort(ranks, axis=1, kind="stable")
                    ranks = np.take_along_axis(ranks, order, axis=1)
                    new = np.ones(ranks.shape, dtype=bool)
                    new[:, 1:] = ranks[:, 1:] != ranks[:, :-1]
                    nth = np.cumsum(new, axis=1)
                    need = np.maximum(1, np.ceil(containment * nth[:, -1] - 1e-9)).astype(np.int32)
                    self.need[part] = need
                    at, column = np.nonzero(new & (nth <= (nth[:, -1] - need + 1)[:, None]))
                    found.append((ranks[at, column], part[at].astype(np.int32), order[at, column].astype(np.int32)))
            ranks, record, place = (np.concatenate(x) for x in zip(*found))
            hashes = by_rank[ranks]
            order = np.argsort(hashes, kind="stable")
            hashes, record, place = hashes[order], record[order], place[order]
            begins = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            low = np.zeros(1 << _LOW, dtype=bool)
            low[hashes & U((1 << _LOW) - 1)] = True
            self.sizes[k] = Prefixes(hashes[begins], low, np.append(begins, len(hashes)).astype(np.int32), record, place)

    def _finds(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, records, places) of prefix shingles in the words."""
        p = self.sizes[k]
        own = grams(hashes, k)
        at = np.flatnonzero(p.low[own & U((1 << _LOW) - 1)])
        j = np.minimum(np.searchsorted(p.keys, own[at]), len(p.keys) - 1)
        hit = p.keys[j] == own[at]
        at, j = at[hit], j[hit]
        times = p.begins[j + 1] - p.begins[j]
        entry = np.repeat(p.begins[j], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at, times), p.record[entry], p.place[entry]

    def hits(self, own: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(first word, word behind the last, record) of every verified window in the rows."""
        out: set[tuple[int, int, int]] = set()
        for k in self.sizes:
            positions, found, places = self._finds(hashes, k)
            if not len(positions):
                continue
            rows = np.searchsorted(first, positions, "right") - 1
            lows, highs = first[rows], first[rows + 1]
            if self.exact:
                s, n = positions - places, self.records.length[found].astype(np.int64)
                fits = (s >= lows) & (s + n <= highs)
                s, n, found = s[fits], n[fits], found[fits]
                same = window_hashes(hashes, s, n) == self.records.whole[found]
                for a, m, r in zip(s[same].tolist(), n[same].tolist(), found[same].tolist()):
                    if b" ".join(own[x:y].tobytes() for x, y in zip(starts[a : a + m], ends[a : a + m])) == self.records.text(r):
                        out.add((a, a + m, r))
                continue
            held: dict[int, np.ndarray] = {}
            for p, r, lo, hi in zip(positions.tolist(), found.tolist(), lows.tolist(), highs.tolist()):
                n, need = int(self.records.length[r]), int(self.need[r])
                width = n - k + 1
                if hi - lo < k - 1 + need:  # too short a text to hold enough shingles
                    continue
                if r not in held:
                    held[r] = np.unique(self.records.shingles(r, k))
                a, b = max(lo, p - width + 1), min(hi, p + width + k - 1)
                near = np.isin(grams(hashes[a:b], k), held[r])
                for s in range(a, min(p, hi - k) + 1):
                    span = near[s - a : s - a + width]
                    if span.sum() >= need:
                        there = grams(hashes[s : min(s + n, b)], k)
                        if len(np.intersect1d(there, held[r])) >= need:
                            inside = np.flatnonzero(span)
                            out.add((int(s + inside[0]), int(s + inside[-1] + k), r))
        return sorted(out)


def _counting(shared: Broadcast):
    """Rows (size, number, n): how often a part of the documents has the shingle of that number in its size's table."""

    def count(batches):
        tables, low = shared.value, {}
        for k, keys in tables.items():
            low[k] = np.zeros(1 << _LOW, dtype=bool)
            low[k][keys & U((1 << _LOW) - 1)] = True
        sums = {k: np.zeros(len(keys), dtype=np.int64) for k, keys in tables.items()}
        for batch in batches:
            column = batch.column(0)
            offsets, data = arrow_text.buffers(column)
            for lo, hi in arrow_text.chunks(offsets):
                *_, hashes, first = words_of(column, lo, hi, offsets, data)
                for k, keys in tables.items():
                    own = grams(hashes, k)
                    at = np.flatnonzero(low[k][own & U((1 << _LOW) - 1)])
                    j = np.minimum(np.searchsorted(keys, own[at]), len(keys) - 1)
                    rows = np.searchsorted(first, at, "right") - 1
                    ok = (keys[j] == own[at]) & (at + k <= first[rows + 1])
                    sums[k] += np.bincount(j[ok], minlength=len(keys))
        for k in tables:
            has = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(has), k, dtype=np.int32)), pa.array(has), pa.array(sums[k][has])], ["size", "number", "n"])

    return count


def _scanning(shared: Broadcast):
    """A function of texts and earlier finds (or null) to their words, hits, spans and items."""

    @arrow_udf("struct<n_words: long, n_hit: long, hit_spans: array<long>, hit_items: array<string>>")
    def scan(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index: Index = shared.value
        for texts, earlier in columns:
            offsets, data = arrow_text.buffers(texts)
            counts, spans, items = [np.zeros(0, dtype=np.int64)], [], []
            for lo, hi in arrow_text.chunks(offsets):
                own, starts, ends, hashes, first = words_of(texts, lo, hi, offsets, data)
                counts.append(np.diff(first))
                own_spans: list[list[int]] = [[] for _ in range(hi - lo)]
                own_items: list[set[str]] = [set() for _ in range(hi - lo)]
                for a, b, r in index.hits(own, starts, ends, hashes, first):
                    i = int(np.searchsorted(first, a, "right")) - 1
                    own_spans[i] += [a - int(first[i]), b - int(first[i])]
                    own_items[i].add(index.records.items[index.records.item[r]])
                spans += own_spans
                items += own_items
            if earlier.null_count < len(earlier):
                before = [x or {"hit_spans": [], "hit_items": []} for x in earlier.to_pylist()]
                spans = [[*x["hit_spans"], *s] for x, s in zip(before, spans)]
                items = [{*x["hit_items"], *s} for x, s in zip(before, items)]
            merged, hit = [], []
            for s in spans:
                edges: list[int] = []
                for a, b in sorted(zip(s[::2], s[1::2])):
                    if edges and a <= edges[-1]:
                        edges[-1] = max(edges[-1], b)
                    else:
                        edges += [a, b]
                merged.append(edges)
                hit.append(sum(edges[1::2]) - sum(edges[::2]))
            out = [pa.array(np.concatenate(counts), pa.int64()), pa.array(hit, pa.int64()), pa.array(merged, pa.list_(pa.int64())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            yield pa.StructArray.from_arrays(out, ["n_words", "n_hit", "hit_spans", "hit_items"])
        arrow_text.tidy()

    return scan


def find_passages(
    documents: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, window: int | None = WINDOW, shingle: int = SHINGLE,
    containment: float = 1.0, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """row (a struct of the carried columns), n_words, n_hit, hit_spans, hit_items of each document.

    hit_spans has first and behind-last word numbers of maximal runs, one after the other; hit_items
    the ids, as strings and sorted, of items with a window there. window None takes whole items.
    """
    spark = documents.sparkSession
    ship_package(spark)
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[item_text_col].alias("text")).dropna()
    item_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-item_bytes // BLOCK_BYTES) or 1
    carry = documents.columns if carry is None else carry
    nothing = F.lit(None).cast("struct<n_words: long, n_hit: long, hit_spans: array<long>, hit_items: array<string>>")
    df = documents.select(F.struct(*(documents[f"`{c}`"] for c in carry)).alias("row"), documents[text_col].alias("text"), nothing.alias("found"))
    texts = documents.select(documents[text_col].alias("text"))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else items
        records = Records.of(sorted((r["item"], r["text"]) for r in part.collect()), window)
        tables = records.tables(shingle)
        counted = texts.mapInArrow(arrow_text.tidied(_counting(spark.sparkContext.broadcast(tables))), "size int, number long, n long")
        counted = counted.groupBy("size", "number").agg(F.sum("n").alias("n")).toArrow()  # at most the block's shingles
        size, number, n = (counted.column(c).to_numpy() for c in ("size", "number", "n"))
        counts = {k: (keys, np.bincount(number[size == k], n[size == k], minlength=len(keys)).astype(np.int64)) for k, keys in tables.items()}
        index = Index(records, counts, shingle, containment)
        df = df.select("row", "text", _scanning(spark.sparkContext.broadcast(index))("text", "found").alias("found"))
    return df.select("row", "found.*")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def item_digest(items: list[str]) -> str:
    """The digest column of a list of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
