"""LM scoring with a log-frequency Bloom filter.

Tokens are lower-cased words and one end a text. Pass 1 counts words and pairs of neighbours (the
text's start counts as an end) of the training texts: each task sends its distinct 64-bit keys with
counts, packed by key range, and each range is summed once. Counts are quantised to levels
1 + floor(log_BASE c); a range's segment of the filter holds (key, 1) to (key, level) under HASHES
bits each, BITS_EACH bits a level. All words and pairs are held, those met once too, so the filter
grows with the corpus: its segments stay with their key ranges, and what is broadcast is its head
alone, the words and pairs with a share of at least 1 / FREQUENT of the tokens. These are fewer than
FREQUENT each and fill at most HEAD_BITS bits a level, whatever the corpus.

Pass 2 cuts the texts into batches. A batch's distinct words and pairs that the head does not hold go
to the segments of their ranges, which read the counts back by probing level after level until one
is missing; the levels return to the batch, where each token gets those of its pair, of the token
before it, and of itself. So no task holds more than a batch or a range, and hot words cost nothing.

A token's probability mixes that of its pair with the word's own: m c(v, w) / c(v) + (1 - m) p(w),
p(w) = (c(w) + 1) / (N + V + 1), each count the mean of its level in the corpus; over all words and
one unknown word the probabilities behind v sum to 1 but for quantising and false hits. The shares
m, one for each level of c(v), maximise the likelihood of all training texts, each pair's own
occurrence left out of its counts; a histogram of the three levels says all that takes.

Base scores use exact counts, which the word ranges return beside the levels.

Word keys are 64-bit hashes of their bytes. Defined results: null and empty texts are one end;
without training texts all counts are 0; repeated rows count each time and get a row each; ids may
be null or of any type; kept columns may have any names.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from quantarium.llm import arrow_text
from quantarium.llm.arrow_text import LOWER, WHITE, U, mix
from quantarium.session import Scratch, ship_package

BASE = 1.5
#: Bits a level, and bits set by each, in the segments and in the head: false hits of 0.3 % and of 5e-9.
BITS_EACH, HASHES = 12, 8
HEAD_BITS, HEAD_HASHES = 40, 28
FREQUENT = 1 << 16
#: Bytes of text whose keys a task packs at once when it counts and when it asks, and tokens that one key range should have.
FLUSH_BYTES = 24 << 20
ASK_BYTES = 12 << 20
RANGE_TOKENS = 3_000_000
END = U(0xE0D0C0B0A0908071)
LEVELS = 64
#: A filter's least size: in fewer bits its hashes would repeat each other.
LEAST_BITS = 1 << 12
PAIR_BITS = 32
WORD, PAIR = 1, 2


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9), LEVELS - 1).astype(np.int64)


def pair_keys(before: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """Keys of pairs of neighbours: of their hash the range's bits and PAIR_BITS more.

    A range has RANGE_TOKENS pairs or so at every corpus size, so another pair has the same key in
    one case of a thousand or fewer, which is little beside the filter's own false hits.
    """
    return mix(before * U(0xD6E8FEB86659FD93) + word) >> U(64 - PAIR_BITS - bits) << U(64 - PAIR_BITS - bits)


def packed(keys: np.ndarray, kind: int, bits: int) -> bytes:
    """Ordered keys of one range: eight bytes a word; of pairs the steps from key to key, all first bytes, all second bytes, and so on."""
    if kind == WORD:
        return keys.astype("<u8").tobytes()
    own = keys << U(bits) >> U(64 - PAIR_BITS)
    return np.diff(own, prepend=U(0)).astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def unpacked(blob: pa.Scalar, kind: int, place: int, bits: int) -> np.ndarray:
    if kind == WORD:
        return np.frombuffer(blob.as_buffer(), "<u8")
    steps = np.ascontiguousarray(np.frombuffer(blob.as_buffer(), "u1").reshape(4, -1).T).view("<u4").ravel()
    return (np.cumsum(steps, dtype=np.uint64) << U(64 - PAIR_BITS - bits)) | (U(place) << U(64 - bits))


def token_stream(lo: int, hi: int, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): words and an end of each of rows lo to hi; the i-th has tokens first[i] to first[i + 1]."""
    own = LOWER[data[offsets[lo] : offsets[hi]]]
    starts, ends, first = arrow_text.word_spans(own, offsets[lo : hi + 1] - offsets[lo], WHITE)
    words = arrow_text.span_hashes(own, starts, ends)
    first = first + np.arange(len(first))
    out = np.full(first[-1], END, dtype=np.uint64)
    keep = np.ones(len(out), dtype=bool)
    keep[first[1:] - 1] = False
    out[keep] = words
    return out, first


def previous(keys: np.ndarray) -> np.ndarray:
    """The token before each; before a text's first stands the end of the one before it or END."""
    return np.concatenate([[END], keys[:-1]]) if len(keys) else keys


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts (1 each by default)."""
    if counts is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[starts], np.diff(np.append(starts, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits key ranges starts in ordered keys."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << U(64 - bits)) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _thin(counts: np.ndarray) -> bytes:
    """Counts in one byte each where they fit, else in four; the first byte tells."""
    return b"\x01" + counts.astype("u1").tobytes() if not len(counts) or counts.max() < 256 else b"\x04" + counts.tobytes()


def _thick(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "u1" if packed[0] == 1 else "<u4", offset=1).astype(np.int64)


@dataclass
class Filter:
    """Bits that hold levels of keys from `least` up."""

    size: int
    bits: np.ndarray
    hashes: int = HASHES
    least: int = 1

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray, bits_each: int = BITS_EACH, hashes: int = HASHES, least: int = 1) -> Filter:
        levels = level_of(counts)
        size = max(LEAST_BITS, -(-int((levels - least + 1).sum()) * bits_each // 8) * 8)
        held = np.zeros(size, dtype=bool)
        for level in range(least, int(levels.max(initial=0)) + 1):
            own = Filter._hashes(keys[levels >= level], level)
            for i in range(hashes):
                held[Filter._place(*own, i, size)] = True
        return Filter(size, np.packbits(held), hashes, least)

    @staticmethod
    def _hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = mix(keys + U(level * 0x9FB21C651E98DF25 % (1 << 64)))
        b = mix(a ^ U(0x5851F42D4C957F2D))
        return a, b, (b << U(31)) | (b >> U(33))

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, c: np.ndarray, i: int, size: int) -> np.ndarray:
        return (((a + (b + c * U(i)) * U(i)) >> U(32)) * U(size)) >> U(32)

    def _has(self, own: tuple, i: int) -> np.ndarray:
        at = self._place(*own, i, self.size)
        return (self.bits[at >> U(3)] >> (U(7) - (at & U(7))).astype(np.uint8)) & 1 == 1

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels by probing one after the other; 0 where the first is missing."""
        found = np.zeros(len(keys), dtype=np.uint8)
        active = np.arange(len(keys))
        for level in range(self.least, LEVELS):
            own = self._hashes(keys[active], level)
            hit = np.flatnonzero(self._has(own, 0) & self._has(own, 1))  # most that are missing stop here
            own, active = tuple(x[hit] for x in own), active[hit]
            hit = np.ones(len(active), dtype=bool)
            for i in range(2, self.hashes):
                hit &= self._has(own, i)
                if i % 8 == 7 and i + 1 < self.hashes and not hit.all():
                    own, active, hit = tuple(x[hit] for x in own), active[hit], hit[hit]
            active = active[hit]
            if not len(active):
                break
            found[active] = level
        return found


def _counting(bits: int):
    """Rows (kind, range, keys, counts) of the training texts."""

    def flush(words: list, pairs: list):
        for kind, parts in ((WORD, words), (PAIR, pairs)):
            keys, counts = summed(np.concatenate(parts))
            at = _ranges(keys, bits)
            cells = [(r, i, j) for r, (i, j) in enumerate(zip(at, at[1:])) if j > i]
            counts = counts.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(cells), pa.int32()), pa.array([r for r, _, _ in cells], pa.int32()), pa.array([packed(keys[i:j], kind, bits) for _, i, j in cells], pa.binary()), pa.array([_thin(counts[i:j]) for _, i, j in cells], pa.binary())],
                ["kind", "range", "keys", "counts"],
            )

    def run(batches):
        words, pairs, size = [], [], 0
        for batch in batches:
            offsets, data = arrow_text.buffers(batch.column(0))
            for lo, hi in arrow_text.chunks(offsets):
                keys, _ = token_stream(lo, hi, offsets, data)
                words.append(keys)
                pairs.append(pair_keys(previous(keys), keys, bits))
                size += offsets[hi] - offsets[lo]
                if size >= FLUSH_BYTES:
                    yield from flush(words, pairs)
                    words, pairs, size = [], [], 0
        if words:
            yield from flush(words, pairs)

    return run


_SEGMENTS = "kind int, range int, size long, bits binary, keys binary, counts binary, total long, distinct long, often_keys array<long>, often_counts array<long>, level_keys array<long>, level_counts array<long>"


def _summing(table: pa.Table, bits: int) -> pa.Table:
    """One key range: its segment, exact counts (of words), sums by level, and the keys that may belong to the head."""
    kind, place = table.column("kind")[0].as_py(), table.column("range")[0].as_py()
    keys = np.concatenate([unpacked(x, kind, place, bits) for x in table.column("keys")])
    counts = np.concatenate([_thick(x.as_py()) for x in table.column("counts")])
    keys, counts = summed(keys, counts)
    total, levels = int(counts.sum()), level_of(counts)
    often = counts * FREQUENT >= total  # a share of all tokens is no larger than one of this range's
    segment = Filter.of(keys, counts)
    exact = [keys.tobytes(), counts.astype("<i8").tobytes()] if kind == WORD else [None, None]
    row = [kind, place, segment.size, segment.bits.tobytes(), *exact, total, len(keys), keys[often].view(np.int64), counts[often], np.bincount(levels, minlength=LEVELS), np.bincount(levels, counts, minlength=LEVELS).astype(np.int64)]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4]
    return pa.table([pa.array([x], t) for x, t in zip(row, types)], names=[x.split()[0] for x in _SEGMENTS.split(", ")])


@dataclass
class Counts:
    """What is known of the training texts: a table of segments by key range, totals, and the head."""

    table: DataFrame
    range_bits: int
    tokens: int
    distinct: int
    heads: dict[int, Filter]
    frequent: np.ndarray
    frequent_counts: np.ndarray
    #: By kind, the mean count of a level's keys; level 0 is count 0.
    means: dict[int, np.ndarray] = field(default_factory=dict)

    def head(self) -> tuple:
        """The part that tasks need, without the table: of bounded size."""
        return self.range_bits, self.heads, self.frequent, self.frequent_counts


def _segments(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    bits = max(2, math.ceil(math.log2(max(1, ((size[0] or 0) / 6 + size[1]) / RANGE_TOKENS))))
    blobs = texts.mapInArrow(arrow_text.tidied(_counting(bits)), "kind int, range int, keys binary, counts binary")
    return scratch.keep(blobs.groupBy("kind", "range").applyInArrow(arrow_text.tidied_group(lambda t: _summing(t, bits)), _SEGMENTS), "segments"), bits


def count(documents: DataFrame, training: Column, scratch: Scratch, text_col: str = "text") -> Counts:
    """Word and pair counts of the texts where `training` holds."""
    ship_package(documents.sparkSession)
    table, bits = _segments(documents.where(training).select(F.coalesce(documents[text_col], F.lit("")).alias("text")), scratch)
    scratch.drop()  # shuffle files of the counts
    totals = table.groupBy("kind").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"))
    totals = {r["kind"]: (r["total"], r["distinct"]) for r in totals.collect()}  # one row a kind
    tokens, distinct = totals.get(WORD, (0, 0))
    means = {k: np.concatenate([[0.0], [max(1.0, (BASE ** (q - 1) + BASE**q - 1) / 2) for q in range(1, LEVELS)]]) for k in (WORD, PAIR)}
    by_level = table.select("kind", F.posexplode(F.arrays_zip("level_keys", "level_counts")).alias("q", "n")).groupBy("kind", "q").agg(F.sum("n.level_keys").alias("keys"), F.sum("n.level_counts").alias("counts"))
    for r in by_level.where("keys > 0").collect():  # at most LEVELS rows a kind
        means[r["kind"]][r["q"]] = r["counts"] / r["keys"]
    often = table.select("kind", F.explode(F.arrays_zip("often_keys", "often_counts")).alias("x")).select("kind", F.col("x.often_keys").alias("key"), F.col("x.often_counts").alias("n"))
    often = often.where(F.col("n") * FREQUENT >= F.lit(max(1, tokens))).toArrow()  # at most FREQUENT rows a kind
    kinds, keys, n = (often.column(c).to_numpy() for c in ("kind", "key", "n"))
    least = int(level_of(np.array([-(-max(1, tokens) // FREQUENT)]))[0])
    order = np.argsort(keys.view(np.uint64))
    kinds, keys, n = kinds[order], keys.view(np.uint64)[order], n[order]
    heads = {k: Filter.of(keys[kinds == k], n[kinds == k], HEAD_BITS, HEAD_HASHES, least) for k in (WORD, PAIR)}
    return Counts(table, bits, tokens, distinct, heads, keys[kinds == WORD], n[kinds == WORD], means)


def _answers(asked: DataFrame, counts: Counts) -> DataFrame:
    """Levels (and words' exact counts) of the keys of each batch and range, in their order."""
    bits = counts.range_bits

    def answer(questions: pa.Table, segment: pa.Table) -> pa.Table:
        out: dict[str, list] = {"batch": questions.column("batch").to_pylist(), "kind": questions.column("kind").to_pylist(), "range": questions.column("range").to_pylist(), "levels": [], "counts": []}
        held = exact = None
        if segment.num_rows:
            f = Filter(segment.column("size")[0].as_py(), np.frombuffer(segment.column("bits")[0].as_py(), np.uint8))
            if segment.column("keys")[0].is_valid:
                held, exact = (np.frombuffer(segment.column(c)[0].as_py(), t) for c, t in (("keys", "<u8"), ("counts", "<i8")))
        for x, kind, place in zip(questions.column("keys"), out["kind"], out["range"]):
            keys = unpacked(x, kind, place, bits)
            out["levels"].append((f.levels(keys) if segment.num_rows else np.zeros(len(keys), np.uint8)).tobytes())
            if held is None:
                out["counts"].append(_thin(np.zeros(len(keys), "<u4")) if out["kind"][0] == WORD else None)
            else:
                j = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                out["counts"].append(_thin(np.where(held[j] == keys, exact[j], 0).astype("<u4")))
        return pa.table({"batch": pa.array(out["batch"], pa.int64()), "kind": pa.array(out["kind"], pa.int32()), "range": pa.array(out["range"], pa.int32()), "levels": pa.array(out["levels"], pa.binary()), "counts": pa.array(out["counts"], pa.binary())})

    questions = asked.where("kind IS NOT NULL").select("batch", "kind", "range", "keys")
    segments = counts.table.select("kind", "range", "size", "bits", "keys", "counts")
    return questions.groupBy("kind", "range").cogroup(segments.groupBy("kind", "range")).applyInArrow(arrow_text.tidied_pair(answer), "batch long, kind int, range int, levels binary, counts binary")


def look_up(documents: DataFrame, counts: Counts, scratch: Scratch, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """row (a struct of `keep`), n_tokens, n_known, base_score and levels of each text.

    levels has three bytes a token: the levels of its pair, of the token before it, and of itself.
    """
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(counts.head())
    df = documents.select(F.struct(*(c.alias(n) for n, c in keep.items())).alias("row"), documents[text_col].cast("string").alias("text"))
    bits = counts.range_bits
    row_field = StructType.fromJson(json.loads(df.schema.json().replace('"nullable":false', '"nullable":true')))["row"]  # as Arrow gives it back

    def ask(batches):
        _, heads, *_ = shared.value
        part, flushed, size, tokens = TaskContext.get().partitionId(), 0, 0, []
        kept = None

        def questions(number: int):
            keys = np.concatenate(tokens)
            kinds, ranges, blobs = [], [], []
            for kind, own in ((WORD, keys), (PAIR, pair_keys(previous(keys), keys, bits))):
                own = np.unique(own)
                own = own[heads[kind].levels(own) == 0]
                at = _ranges(own, bits)
                cells = [(r, i, j) for r, (i, j) in enumerate(zip(at, at[1:])) if j > i]
                kinds += [kind] * len(cells)
                ranges += [r for r, _, _ in cells]
                blobs += [packed(own[i:j], kind, bits) for _, i, j in cells]
            n = len(kinds)
            return pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int64()), pa.nulls(n, kept.column(0).type), pa.nulls(n, kept.column(1).type), pa.array(kinds, pa.int32()), pa.array(ranges, pa.int32()), pa.array(blobs, pa.binary())], names)

        for batch in batches:
            kept = batch
            offsets, data = arrow_text.buffers(batch.column(1))
            for lo, hi in arrow_text.chunks(offsets):
                tokens.append(token_stream(lo, hi, offsets, data)[0])
                n, number = hi - lo, (part << 24) | flushed
                yield pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int64()), batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
                size += offsets[hi] - offsets[lo]
                if size >= ASK_BYTES:
                    yield questions(number)
                    size, tokens, flushed = 0, [], flushed + 1
        if tokens:
            yield questions((part << 24) | flushed)

    names = ["batch", "row", "text", "kind", "range", "keys"]
    schema = StructType([StructField("batch", LongType()), row_field, StructField("text", StringType()), StructField("kind", IntegerType()), StructField("range", IntegerType()), StructField("keys", BinaryType())])
    asked = scratch.keep(df.mapInArrow(arrow_text.tidied(ask), schema), "asked")

    answers = scratch.keep(_answers(asked, counts), "answers")
    scratch.drop()  # shuffle files of the questions
    tokens_and_words = math.log10(counts.tokens + counts.distinct + 1)

    def gather(texts: pa.Table, levels: pa.Table) -> pa.Table:
        _, heads, frequent, frequent_counts = shared.value
        order = np.lexsort((levels.column("range").to_numpy(), levels.column("kind").to_numpy()))
        kinds, blobs, exact = levels.column("kind").to_pylist(), levels.column("levels").to_pylist(), levels.column("counts").to_pylist()
        column = texts.column("text").combine_chunks()
        offsets, data = arrow_text.buffers(column)
        streams = [token_stream(lo, hi, offsets, data) for lo, hi in arrow_text.chunks(offsets)]
        keys = np.concatenate([x for x, _ in streams])
        sizes = np.concatenate([np.diff(first) for _, first in streams])
        first = np.concatenate([[0], np.cumsum(sizes)])

        def levels_of(kind: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            distinct, at = np.unique(own, return_inverse=True)
            found = heads[kind].levels(distinct)
            rest = found == 0
            parts = [np.frombuffer(blobs[i], np.uint8) for i in order if kinds[i] == kind]
            found[rest] = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            return distinct, rest, found, at

        distinct, rest, found, at = levels_of(WORD, keys)
        n = np.zeros(len(distinct), dtype=np.int64)
        if len(frequent):
            j = np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)
            n = np.where(frequent[j] == distinct, frequent_counts[j], 0)
        parts = [_thick(exact[i]) for i in order if kinds[i] == WORD]
        n[rest] = np.concatenate(parts) if parts else 0
        logs = np.add.reduceat(np.log10(n + 1.0)[at], first[:-1]) - sizes * tokens_and_words
        known = np.add.reduceat((n > 0).astype(np.int64)[at], first[:-1])
        codes = np.empty((len(keys), 3), dtype=np.uint8)
        codes[:, 2] = found[at]
        codes[1:, 1] = codes[:-1, 2]
        codes[0, 1] = found[np.searchsorted(distinct, END)]  # other texts' first tokens stand behind an end already
        del distinct, at, n
        _, _, found, at = levels_of(PAIR, pair_keys(previous(keys), keys, bits))
        codes[:, 0] = found[at]
        blob = codes.tobytes()
        blobs = [blob[3 * i : 3 * j] for i, j in zip(first.tolist(), first[1:].tolist())]
        return pa.table({"row": texts.column("row"), "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(known, pa.int64()), "base_score": pa.array(logs, pa.float64()), "levels": pa.array(blobs, pa.binary())})

    texts = asked.where("kind IS NULL").select("batch", "row", "text")
    schema = StructType([row_field, StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("levels", BinaryType())])
    out = texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(arrow_text.tidied_pair(gather), schema)
    out = scratch.keep(out, "levels")
    scratch.drop("asked", "answers")
    return out


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cells, first): one number for the three levels of each token, and each row's first token."""
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    first = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] // 3
    codes = np.frombuffer(data, np.uint8)[3 * first[0] : 3 * first[-1]].reshape(-1, 3).astype(np.int64)
    return (codes[:, 0] * LEVELS + codes[:, 1]) * LEVELS + codes[:, 2], first - first[0]


def tune(levels: DataFrame) -> np.ndarray:
    """How often each cell of three levels occurs: LEVELS cubed numbers, whatever the number of texts."""

    def run(batches):
        out = np.zeros(LEVELS**3, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                out += np.bincount(_cells(batch.column(0))[0], minlength=len(out))
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["cell", "n"])

    found = levels.select("levels").mapInArrow(arrow_text.tidied(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(LEVELS**3, dtype=np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def probabilities(counts: Counts, seen: np.ndarray) -> np.ndarray:
    """The probability of a token for each cell, with the shares that suit the training texts' cells best."""
    at = np.arange(LEVELS**3)
    joint, context, own = at // LEVELS**2, at // LEVELS % LEVELS, at % LEVELS
    c_joint, c_context, c_own = counts.means[PAIR][joint], counts.means[WORD][context], counts.means[WORD][own]
    alone = (c_own + 1) / (counts.tokens + counts.distinct + 1)
    # leaving the token itself out of its counts
    left = np.where(joint > 1, np.minimum((c_joint - 1) / np.maximum(c_context - 1, 1), 1), 0.0)
    ratio = left * (counts.tokens + counts.distinct) / np.maximum(c_own, 1)
    shares = np.zeros(LEVELS)
    for g in range(1, LEVELS):
        use = (context == g) & (seen > 0)
        n, r = seen[use], ratio[use]
        if n.sum():
            m = 0.5
            for _ in range(200):
                m = min(max(float((n * m * r / (m * r + 1 - m)).sum() / n.sum()), 1e-6), 1 - 1e-3)
            shares[g] = m
    m = shares[context]
    return m * np.minimum(c_joint / np.maximum(c_context, 1), 1) + (1 - m) * alone


def score(levels: DataFrame, table: np.ndarray) -> DataFrame:
    """The rows with score: the sum of their tokens' log10 probabilities, in place of levels."""
    shared = levels.sparkSession.sparkContext.broadcast(np.log10(table))  # LEVELS cubed numbers
    schema = StructType([StructField("score", DoubleType()) if f.name == "levels" else f for f in levels.schema])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cells, first = _cells(batch.column(batch.num_columns - 1))
                total = np.add.reduceat(shared.value[cells], first[:-1])  # each text has an end at least
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total)], [f.name for f in schema])

    return levels.mapInArrow(arrow_text.tidied(run), schema)


def scored(documents: DataFrame, training: Column, keep: dict[str, Column], scratch: Scratch, text_col: str = "text") -> tuple[DataFrame, Counts]:
    """row (a struct of `keep`), n_tokens, n_known, base_score and score of each text, learnt where `training` holds."""
    counts = count(documents, training, scratch, text_col)
    levels = look_up(documents, counts, scratch, {"kept": F.struct(*(c.alias(n) for n, c in keep.items())), "training": training}, text_col)
    table = probabilities(counts, tune(levels.where("row.training")))
    return score(levels.withColumn("row", F.col("row.kept")), table), counts


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(docs.doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))
    out, counts = scored(docs, ~held, {"doc_id": docs.doc_id, "held_out": held}, Scratch(spark, "lm-scoring"))
    return out.select("row.doc_id", "row.held_out", "n_tokens", "n_known", F.lit(counts.tokens).cast("long").alias("train_tokens"), "base_score", "score")
