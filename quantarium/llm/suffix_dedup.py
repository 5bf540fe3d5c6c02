"""Suffix-array dedup: later copies of long byte strings go, the first stays.

Every SPAN-byte window of a text has a minimizer, the least-hashed of its GRAM-byte strings; equal
windows have equal minimizers at equal places. Runs of windows with one minimizer form a block
(SPAN bytes and a byte for each further window), so all windows with the same bytes can be met
under one key. The steps:

1. Tasks send the minimizers of their texts, packed by key range; one that texts of two ids hold is
   told to these texts. One that a task itself sees twice is sent once and told at once.
2. Texts with such minimizers cut out their blocks. A task sends each distinct block once, with the
   least id that has it there, however many copies it has seen.
3. For a key range the suffixes at the blocks' windows are sorted (to a depth of SPAN bytes), with
   the longest common prefixes of neighbours. The previous and the next suffix of a smaller id in
   that order give each suffix's longest previous factor; SPAN bytes of it mark its window.
4. Marks go back by task to the texts. A text whose task saw its block under a smaller id loses the
   whole block, else its marked windows; runs of lost bytes are merged.

Equal texts need no suffixes: all but the least id lose everything (if SPAN bytes long).

Defined results: null texts are empty; texts shorter than SPAN lose nothing; equal ids don't count
as earlier than each other, so a repeated row changes nothing; rows with a null id lose nothing and
count nowhere.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quantarium.llm import arrow_text
from quantarium.llm.arrow_text import BYTE_VALUE, U, mix
from quantarium.session import Scratch, ship_package

SPAN = 50
GRAM = 16
#: Bytes of text that a task packs at once; longer texts are cut with SPAN - 1 bytes of overlap.
FLUSH_BYTES = 16 << 20
ASK_BYTES = 8 << 20
#: Entries of one packed row: long rows are large objects in the JVM.
ROW_ENTRIES = 20_000
SEGMENT = 1 << 19
#: Minimizers of a key range in step 1, and bytes of blocks in step 3.
RANGE_KEYS = 750_000
RANGE_BYTES = 2 << 20
_PLACE = U((1 << 24) - 1)
_LOW = U((1 << 40) - 1)


def segments(offsets: np.ndarray):
    """(lo, hi, begin, end, done): rows lo to hi, or bytes begin to end of one long row and whether they end it."""
    for lo, hi in arrow_text.chunks(offsets, SEGMENT):
        if offsets[hi] - offsets[lo] <= SEGMENT:
            yield lo, hi, int(offsets[lo]), int(offsets[hi]), True
            continue
        at, end = int(offsets[lo]), int(offsets[hi])
        while at + SEGMENT < end:
            yield lo, hi, at, at + SEGMENT, False
            at += SEGMENT - SPAN + 1
        yield lo, hi, at, end, True


def minimizer_runs(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, key): runs of window starts with one minimizer, inside single rows."""
    n, none = len(data), np.zeros(0, dtype=np.int64)
    if n < span:
        return none, none, none.view(np.uint64)
    powers, inverse = arrow_text._powers(max(19, n.bit_length()))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers[:n], out=sums[1:])
    value = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    least = (value & ~_PLACE) | np.arange(len(value), dtype=np.uint64)
    width, full = 1, span - gram + 1
    while width < full:
        step = min(width, full - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & _PLACE).astype(np.int64)
    valid = np.ones(len(place), dtype=bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        valid[max(a, b - span + 1) : b] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none.view(np.uint64)
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (place[at[1:]] != place[at[:-1]])])
    begin = np.flatnonzero(new)
    first, last = at[begin], at[np.append(begin[1:], len(at)) - 1]
    return first, last, mix(value[place[first]] ^ U(0x3C6EF372FE94F82B))  # least hashes are small: mixed again, they spread over all ranges


def short_keys(keys: np.ndarray, bits: int) -> np.ndarray:
    """A key's range (its first bits) and its last 40 bits."""
    return (keys >> U(64 - bits) << U(40)) | (keys & _LOW)


def _pack5(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack5(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :5] = raw
    return out.view("<u8").reshape(-1)


def _binary(parts: list) -> pa.Array:
    return pa.array(parts, pa.binary())


# step 1


def _asking(bits: int):
    """Rows of kind 0 (asked minimizers by range), 1 (known as shared at once) and 2 (ids) of a batch."""

    def flush(batch_id: int, keys: list, owners: list, ids: list, hashes: list):
        ids_, hashes_ = np.concatenate(ids), np.concatenate(hashes)
        keys_, owners_ = short_keys(np.concatenate(keys), bits), np.concatenate(owners)
        order = np.argsort(keys_, kind="stable")
        keys_, owners_ = keys_[order], owners_[order]
        start = np.flatnonzero(np.concatenate([[True], keys_[1:] != keys_[:-1]])) if len(keys_) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(keys_)))
        if len(start):
            own = ids_[owners_]
            many = np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start)
        else:
            many = np.zeros(0, dtype=bool)
        told = np.repeat(many, size)
        asked = owners_[start].astype("<u4")
        asked[many] = 0xFFFFFFFF  # no answer needed
        heads = keys_[start]
        at = np.searchsorted(heads >> U(40), np.arange((1 << bits) + 1, dtype=np.uint64))
        cells = [(r, i, j) for r, (i, j) in enumerate(zip(at, at[1:])) if j > i]
        told_keys, told_rows = keys_[told], owners_[told].astype("<u4")
        cuts = range(0, max(len(told_keys), 1), ROW_ENTRIES)
        n, more = len(cells), len(cuts)
        out = [
            pa.array([0] * n + [1] * more + [2], pa.int32()), pa.array([batch_id] * (n + more + 1), pa.int64()), pa.array([r for r, _, _ in cells] + [None] * (more + 1), pa.int32()),
            _binary([_pack5(heads[i:j]) for _, i, j in cells] + [told_keys[i : i + ROW_ENTRIES].tobytes() for i in cuts] + [ids_.astype("<i8").tobytes()]),
            _binary([asked[i:j].tobytes() for _, i, j in cells] + [told_rows[i : i + ROW_ENTRIES].tobytes() for i in cuts] + [hashes_.astype("<i8").tobytes()]),
        ]
        return pa.RecordBatch.from_arrays(out, ["kind", "batch", "range", "keys", "rows"])

    def run(batches):
        part, flushed = TaskContext.get().partitionId(), 0
        keys, owners, ids, hashes, size, begun = [], [], [], [], 0, 0
        for batch in batches:
            offsets, data = arrow_text.buffers(batch.column(2))
            ids_, hashes_ = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for lo, hi, a, b, done in segments(offsets):
                first, _, key = minimizer_runs(data[a:b], np.clip(offsets[lo : hi + 1], a, b) - a)
                row = np.searchsorted(offsets[lo : hi + 1], first + a, "right") - 1
                keys.append(key)
                owners.append(row + begun)
                if done:
                    ids.append(ids_[lo:hi])
                    hashes.append(hashes_[lo:hi])
                    begun += hi - lo
                    size += int(offsets[hi] - offsets[lo])
                if size >= ASK_BYTES:
                    yield flush((part << 24) | flushed, keys, owners, ids, hashes)
                    keys, owners, ids, hashes, size, begun, flushed = [], [], [], [], 0, 0, flushed + 1
        if ids:
            yield flush((part << 24) | flushed, keys, owners, ids, hashes)

    return run


def _telling(table: pa.Table) -> pa.Table:
    """The minimizers of one range that several batches hold, back to each batch."""
    place = U(table.column("range")[0].as_py())
    keys = [_unpack5(x.as_py()) for x in table.column("keys")]
    rows = [np.frombuffer(x.as_py(), "<u4") for x in table.column("rows")]
    batch = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key, row = np.concatenate(keys), np.concatenate(rows)
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), dtype=bool)
    equal = key[order][1:] == key[order][:-1]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    same &= row != 0xFFFFFFFF
    out = [np.flatnonzero(same & (batch == b)) for b in range(len(keys))]
    return pa.table(
        {"kind": pa.array([1] * len(keys), pa.int32()), "batch": table.column("batch"),
         "keys": _binary([((place << U(40)) | key[i]).tobytes() for i in out]), "rows": _binary([row[i].tobytes() for i in out])}
    )


def _by_text(table: pa.Table) -> pa.Table:
    """Rows (id, h, keys) of one batch: each text's shared minimizers."""
    kinds = table.column("kind").to_pylist()
    ids = hashes = np.zeros(0, np.int64)
    keys, rows = [], []
    for kind, k, r in zip(kinds, table.column("keys"), table.column("rows")):
        if kind == 2:
            ids, hashes = np.frombuffer(k.as_py(), "<i8"), np.frombuffer(r.as_py(), "<i8")
        else:
            keys.append(np.frombuffer(k.as_py(), "<u8"))
            rows.append(np.frombuffer(r.as_py(), "<u4"))
    keys, rows = np.concatenate(keys), np.concatenate(rows).astype(np.int64)
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    start = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    edge = np.append(start, len(rows))
    own = rows[start]
    return pa.table({"id": pa.array(ids[own]), "h": pa.array(hashes[own]), "keys": _binary([keys[i:j].tobytes() for i, j in zip(edge, edge[1:])])})


# step 2


def _blocks(bits: int, ranges: int):
    """Rows of kind 0 (distinct blocks of a range: lengths, bytes, least ids) and 1 (where texts have them)."""

    def flush(batch_id: int, blocks: dict, places: array, least: array, where: array, ids: list, hashes: list):
        names = list(blocks)
        place = np.array(places, dtype=np.int64)
        order = np.argsort(place, kind="stable")
        edge = np.searchsorted(place[order], np.arange(ranges + 1))
        n = 0
        out: list[list] = [[], [], [], [], [], []]
        for r, (i, j) in enumerate(zip(edge, edge[1:])):
            if j > i:
                own = order[i:j]
                texts = [names[x] for x in own]
                for column, value in zip(out, (0, r, np.fromiter(map(len, texts), "<u4", len(texts)).tobytes(), pa.compress(b"".join(texts), codec="zstd", asbytes=True), np.array(least, dtype="<i8")[own].tobytes(), own.astype("<u4").tobytes())):
                    column.append(value)
                n += 1
        spots = np.array(where, dtype="<u4").reshape(-1, 3)
        sizes = np.stack([np.fromiter(map(len, names), "<i8", len(names)), np.array(least, dtype="<i8")], axis=1)
        for i in range(0, max(len(spots), len(sizes)), ROW_ENTRIES):
            whole = (np.array(ids, dtype="<i8").tobytes(), np.array(hashes, dtype="<i8").tobytes()) if not i else (b"", b"")
            for column, value in zip(out, (1, None, spots[i : i + ROW_ENTRIES].tobytes(), *whole, i.to_bytes(8, "little") + sizes[i : i + ROW_ENTRIES].tobytes())):
                column.append(value)
        kinds, places, *rest = out
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array([batch_id] * len(kinds), pa.int64()), pa.array(places, pa.int32()), *map(_binary, rest)], ["kind", "batch", "range", "lengths", "bytes", "ids", "numbers"])

    def run(batches):
        part, flushed = TaskContext.get().partitionId(), 0
        blocks: dict[bytes, int] = {}
        places, least, where, ids, hashes, size = array("q"), array("q"), array("I"), [], [], 0
        for batch in batches:
            offsets, data = arrow_text.buffers(batch.column(2))
            id_list, hash_list, shared = (batch.column(c).to_pylist() for c in (0, 1, 3))
            held, pushed = [np.frombuffer(x, "<u8") for x in shared], -1
            for lo, hi, a, b, done in segments(offsets):
                first, last, key = minimizer_runs(data[a:b], np.clip(offsets[lo : hi + 1], a, b) - a)
                short = short_keys(key, bits)
                edge = np.searchsorted(first, np.clip(offsets[lo : hi + 1], a, b) - a)
                whole = data[a:b].tobytes()
                for row in range(lo, hi):
                    i, j = edge[row - lo], edge[row - lo + 1]
                    if j == i:
                        continue
                    mine = np.flatnonzero(np.isin(short[i:j], held[row])) + i
                    if not len(mine):
                        continue
                    if pushed != row:
                        ids.append(id_list[row])
                        hashes.append(hash_list[row])
                        pushed = row
                    owner, own_id, base = len(ids) - 1, id_list[row], a - int(offsets[row])
                    for f, e, k in zip(first[mine].tolist(), (last[mine] + SPAN).tolist(), (mix(key[mine]) % U(ranges)).tolist()):
                        number = blocks.setdefault(whole[f:e], len(least))
                        if number == len(least):
                            least.append(own_id)
                            places.append(k)
                        elif own_id < least[number]:
                            least[number] = own_id
                        where.extend((owner, base + f, number))
                size += b - a
                if size >= FLUSH_BYTES and blocks and done:
                    yield flush((part << 24) | flushed, blocks, places, least, where, ids, hashes)
                    blocks, places, least, where = {}, array("q"), array("q"), array("I")
                    ids, hashes, size, flushed, pushed = [], [], 0, flushed + 1, -1
        if blocks:
            yield flush((part << 24) | flushed, blocks, places, least, where, ids, hashes)

    return run


# step 3


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): suffixes at starts sorted by their first `depth` bytes; lcp[i] of order[i - 1] and order[i].

    Equal suffixes are brought together by a hash first (and compared), so that only one of each is sorted by its bytes.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(data) + 8, dtype=np.uint64)
    for i in range(8):
        eight |= padded[i : i + len(eight)] << U(56 - 8 * i)
    rest = depth % 8
    words = [eight[starts + j] for j in range(0, depth, 8)]
    if rest:
        words[-1] = words[-1] >> U(64 - 8 * rest) << U(64 - 8 * rest)
    key = np.zeros(n, dtype=np.uint64)
    for word, step in zip(words, arrow_text._STEPS):
        key += word * step
    key = mix(key)
    near = np.argsort(key, kind="stable")
    key = key[near]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, n))
    heads = near[first]
    if any((word[near] != np.repeat(word[heads], size)).any() for word in words):  # a collision: sort them all
        near, first, size, heads = np.arange(n), np.arange(n), np.ones(n, dtype=np.int64), np.arange(n)
    rank = np.lexsort([word[heads] for word in words[::-1]])
    first, size, heads = first[rank], size[rank], heads[rank]
    begin = np.cumsum(size) - size
    order = near[np.arange(n) + np.repeat(first - begin, size)]
    lcp = np.full(n, depth)
    between = np.zeros(len(heads), dtype=np.int64)
    open_ = np.arange(1, len(heads))
    for j, word in enumerate(words):
        differ = word[heads[open_]] ^ word[heads[open_ - 1]]
        same = np.full(len(open_), min(8, depth - 8 * j))
        for i in range(7, -1, -1):
            same[(differ >> U(56 - 8 * i)) != 0] = i
        between[open_] += np.minimum(same, min(8, depth - 8 * j))
        open_ = open_[differ == 0]
    lcp[begin] = between
    return order, lcp


def nearest_smaller(values: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, shared): the nearest smaller value to the left (-1: none) and the least lcp on the way there.

    All entries jump at once along the entries they have found so far to be no smaller.
    """
    at, shared = np.arange(len(values)) - 1, lcp.copy()
    active = np.flatnonzero((at >= 0) & (values[np.maximum(at, 0)] >= values))
    while len(active):
        mid = at[active]
        jump, least = at[mid], np.minimum(shared[active], shared[mid])
        at[active], shared[active] = jump, least
        active = active[(jump >= 0) & (values[np.maximum(jump, 0)] >= values[active])]
    shared[at < 0] = 0
    return at, shared


def met_again(data: np.ndarray, starts: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """Which of the ordered starts may have the first `depth` bytes of another one (by a hash: none that has is missed)."""
    key = arrow_text.span_hashes(data, starts, starts + depth)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(starts), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def longest_previous(data: np.ndarray, starts: np.ndarray, owners: np.ndarray, depth: int = SPAN, least: int = 1) -> np.ndarray:
    """Longest previous factors, to `depth` bytes: of each suffix with any suffix of a smaller owner; less than `least` counts as none."""
    order, lcp = suffix_order(data, starts, depth)
    out = np.zeros(len(starts), dtype=np.int64)
    reach = lcp >= least
    held = np.flatnonzero(reach | np.append(reach[1:], False))  # the others share too little with both neighbours
    order, lcp = order[held], lcp[held]
    values = owners[order]
    _, before = nearest_smaller(values, lcp)
    # the next smaller value is the previous one of the reversed order, with lcp shifted by one
    _, after = nearest_smaller(values[::-1], np.concatenate([[0], lcp[1:][::-1]]) if len(lcp) else lcp)
    found = np.maximum(before, after[::-1])
    out[order] = np.where(found >= least, found, 0)
    return out


def _marking(table: pa.Table) -> pa.Table:
    """One key range: the lost spans of each batch's blocks as (number, begin, end)."""
    lengths = [np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in table.column("lengths")]
    length = np.concatenate(lengths)
    packed = zip(table.column("bytes"), lengths)
    data = np.frombuffer(b"".join(pa.decompress(x.as_py(), decompressed_size=int(n.sum()), codec="zstd", asbytes=True) for x, n in packed), np.uint8)
    owner = np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in table.column("ids")])
    number = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("numbers")]).astype(np.int64)
    batch = np.repeat(np.arange(len(lengths)), [len(x) for x in lengths])
    windows, begin = length - SPAN + 1, np.cumsum(length) - length
    block = np.repeat(np.arange(len(length)), windows)
    inside = np.arange(len(block)) - np.repeat(np.cumsum(windows) - windows, windows)
    # a suffix alone with its first SPAN bytes has no factor of that length: it needs no place in the order
    at = np.flatnonzero(met_again(data, begin[block] + inside))
    at = at[longest_previous(data, (begin[block] + inside)[at], owner[block[at]], least=SPAN) >= SPAN]
    new = np.concatenate([[True], (block[at][1:] != block[at][:-1]) | (inside[at][1:] > inside[at][:-1] + SPAN)]) if len(at) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(at)) - 1 if len(first) else first
    marks = np.stack([number[block[at[first]]], inside[at[first]], inside[at[final]] + SPAN], axis=1).astype("<u4") if len(first) else np.zeros((0, 3), "<u4")
    of = batch[block[at[first]]] if len(first) else np.zeros(0, np.int64)
    return pa.table({"kind": pa.array([2] * len(lengths), pa.int32()), "batch": table.column("batch"), "lengths": _binary([marks[of == b].tobytes() for b in range(len(lengths))])})


# step 4


def merged(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spans as maximal runs, begin and end in turn."""
    if not len(begins):
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(begins)) - 1
    return np.stack([begins[new], ends[last]], axis=1).reshape(-1)


def _placing(table: pa.Table) -> pa.Table:
    """One batch: rows (id, h, spans) of texts that lose bytes."""
    marks, parts = [], []
    for row in table.to_pylist():
        if row["kind"] == 1:
            parts.append((int.from_bytes(row["numbers"][:8], "little"), row))
        else:
            marks.append(np.frombuffer(row["lengths"], "<u4").astype(np.int64).reshape(-1, 3))
    parts = [row for _, row in sorted(parts, key=lambda x: x[0])]
    spots = np.frombuffer(b"".join(r["lengths"] for r in parts), "<u4").astype(np.int64).reshape(-1, 3)
    ids, hashes = (np.frombuffer(parts[0][c], "<i8") for c in ("bytes", "ids"))
    sizes = np.frombuffer(b"".join(r["numbers"][8:] for r in parts), "<i8").reshape(-1, 2)
    marks = np.concatenate(marks) if marks else np.zeros((0, 3), dtype=np.int64)
    marks = marks[np.argsort(marks[:, 0], kind="stable")]
    owner, place, number = spots.T
    later = ids[owner] > sizes[number, 1]
    rows, begins, ends = [owner[later]], [place[later]], [place[later] + sizes[number[later], 0]]
    first = ~later
    a, b = (np.searchsorted(marks[:, 0], number[first], side) for side in ("left", "right"))
    count = b - a
    i = np.repeat(a, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    rows.append(np.repeat(owner[first], count))
    begins.append(np.repeat(place[first], count) + marks[i, 1])
    ends.append(np.repeat(place[first], count) + marks[i, 2])
    rows, begins, ends = map(np.concatenate, (rows, begins, ends))
    order = np.argsort(rows, kind="stable")
    rows, begins, ends = rows[order], begins[order], ends[order]
    own = np.unique(rows)
    edge = np.append(np.searchsorted(rows, own), len(rows))
    spans = [merged(begins[i:j], ends[i:j]).astype("<i8").tobytes() for i, j in zip(edge, edge[1:])]
    return pa.table({"id": pa.array(ids[own]), "h": pa.array(hashes[own]), "spans": _binary(spans)})


def repeated_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, h (xxhash64 of the text) and spans of each text that loses bytes: begin and end in turn, packed; none for the whole."""
    spark = documents.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "suffix-dedup")
    text = F.coalesce(documents[text_col].cast("string"), F.lit(""))
    base = documents.select(documents[id_col].cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).where("id IS NOT NULL")
    digests = scratch.keep(base.where(F.octet_length("text") >= SPAN).select("id", "h", F.octet_length("text").cast("long").alias("n"), F.unhex(F.md5("text")).alias("md5")), "digests")
    total = digests.agg(F.sum("n")).first()[0] or 0
    bits = max(2, math.ceil(math.log2(max(1, 0.055 * total / RANGE_KEYS))))

    asked = scratch.keep(base.mapInArrow(arrow_text.tidied(_asking(bits)), "kind int, batch long, range int, keys binary, rows binary"), "asked")
    told = asked.where("kind = 0").groupBy("range").applyInArrow(arrow_text.tidied_group(_telling), "kind int, batch long, keys binary, rows binary")
    back = told.unionByName(asked.where("kind > 0").drop("range"))
    shared = back.groupBy("batch").applyInArrow(arrow_text.tidied_group(_by_text), "id long, h long, keys binary")
    firsts = digests.groupBy("md5").agg(F.min("id").alias("first"))
    judged = digests.join(firsts, "md5")
    single = judged.where("id = first").select("id", "h").distinct()
    wanted = scratch.keep(shared.join(single, ["id", "h"]).groupBy("id", "h").agg(F.first("keys").alias("keys")), "wanted")
    scratch.drop("asked")

    ranges = max(4, math.ceil(0.8 * total / RANGE_BYTES))
    blocks = scratch.keep(base.join(wanted, ["id", "h"]).select("id", "h", "text", "keys").mapInArrow(arrow_text.tidied(_blocks(bits, ranges)), "kind int, batch long, range int, lengths binary, bytes binary, ids binary, numbers binary"), "blocks")
    scratch.drop("wanted")
    marks = blocks.where("kind = 0").groupBy("range").applyInArrow(arrow_text.tidied_group(_marking), "kind int, batch long, lengths binary")
    places = marks.unionByName(blocks.where("kind = 1").drop("range"), allowMissingColumns=True)
    spans = places.groupBy("batch").applyInArrow(arrow_text.tidied_group(_placing), "id long, h long, spans binary")
    whole = judged.where("id > first").select("id", "h", F.lit(b"").alias("spans"))
    found = scratch.keep(spans.unionByName(whole).groupBy("id", "h").agg(F.first("spans").alias("spans")), "spans")
    scratch.drop("blocks")
    return found


def drop_repeats(documents: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """row (a struct of the carried columns), kept (remaining bytes, or text without characters cut in two), n_bytes, n_removed and spans (begin and end in turn) of each row."""
    carry = documents.columns if carry is None else carry
    found = repeated_spans(documents, id_col, text_col)
    text = F.coalesce(documents[text_col].cast("string"), F.lit(""))
    rows = documents.select(F.struct(*(documents[f"`{c}`"] for c in carry)).alias("row"), documents[id_col].cast("long").alias("id"), F.xxhash64(text).alias("h"), *([] if text_col in carry else [text.alias("text")]))
    # a text that the row carries goes through the join once, in it
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")) if text_col in carry else F.col("text")
    rows = rows.join(found, ["id", "h"], "left").select("row", text.alias("text"), "spans")

    kind = "string" if as_text else "binary"

    @arrow_udf(f"struct<kept: {kind}, n_bytes: long, n_removed: long, spans: array<long>>")
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in columns:
            offsets, data = arrow_text.buffers(texts)
            whole = data.tobytes()
            kept, gone, spans = [], [], []
            for i, packed in enumerate(found.to_pylist()):
                a, b = int(offsets[i]), int(offsets[i + 1])
                s = [] if packed is None else np.frombuffer(packed, "<i8").tolist() or [0, b - a]
                edges = [0, *s, b - a]
                kept.append(b"".join(whole[a + x : a + y] for x, y in zip(edges[::2], edges[1::2])) if s else whole[a:b])
                gone.append(sum(s[1::2]) - sum(s[::2]))
                spans.append(s)
            out = pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text else _binary(kept)
            yield pa.StructArray.from_arrays([out, pa.array(np.diff(offsets)), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.int64()))], ["kept", "n_bytes", "n_removed", "spans"])
        arrow_text.tidy()

    once = cut.asNondeterministic()  # else a filter above would have every text cut twice
    return rows.select("row", once("text", "spans").alias("found")).select("row", "found.*")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()
