"""Toxicity by a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, and whatever is no letter or digit counts as one space between words. Its features are the character
n-grams of SIZES that occur in it, each once, spaces at the ends of words included. From labelled texts come the counts of texts a
feature and label, and from these its log-count ratio r = log((toxic + 1) / (n_toxic + 2)) - log((clean + 1) / (n_clean + 2)).
Features within DEVIATIONS standard errors of 0 say nothing and are dropped. A logistic regression over the features times r
(L2 penalty) gives the weights; the score is its probability of label 1.

The fit takes a bounded sample of labelled rows: those with the smallest hashes of their ids, about SAMPLE_ROWS in all but about
LABEL_ROWS of each label, or all if there are fewer (documented bounds, the same at every size); of each the whole text, equal texts of
one label once. Rows carry the weight that gives labels their shares among all labelled rows. Counts are summed by Spark; what
reaches the driver are the sample's telling features, bounded as it is. All documents are scored, in one scan.

Defined results: null and empty texts have no features and score by the intercept; without labelled rows of both labels everything
scores the share of label 1 (0 without any); a document or label row that occurs twice counts twice; null ids meet no label and a
null label teaches nothing; repeated rows get equal scores; carried columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quantarium.llm import arrow_text
from quantarium.session import Scratch, ship_package

SAMPLE_ROWS = 12_000
LABEL_ROWS = 3_000
SIZES = (3, 4, 5, 6)
#: Standard errors from 0 under which a log-count ratio counts as none.
DEVIATIONS = 4.0
#: L2 penalty of the regression's weights, over the mean loss.
PENALTY = 1e-4
STEPS = 200
#: Rows, or features, that a step sums at once.
FIT_ROWS = 1 << 10
#: Values of the ids' hash that the sample tells apart.
PLACES = 1 << 40
#: Characters whose n-grams are hashed at once.
PIECE = 1 << 18
#: N-grams of texts that a task counts together.
HELD_GRAMS = 1 << 20
#: Bits of a hash that place it in a table that tells most unknown n-grams before the search.
SLOT_BITS = 20
U = np.uint64
_FACTORS = arrow_text.mix(np.arange(101, 101 + max(SIZES), dtype=np.uint64)) | U(1)


def code_points(text: str) -> np.ndarray:
    """The text in lower case between spaces, runs of other characters than letters and digits as one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype=np.uint32)
    points = np.where((points < 128) & arrow_text.NOT_ALNUM[np.minimum(points, 127)], np.uint32(32), points)
    space = points == 32
    return points[~(space & np.concatenate([[False], space[:-1]]))]


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each n-gram of that size."""
    n = len(points) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, size, dtype=np.uint64)
    wide = points.astype(np.uint64)
    for j in range(size):
        out += wide[j : j + n] * _FACTORS[j]
    return arrow_text.mix(out)


def pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """Overlapping parts that together hold each n-gram."""
    for at in range(0, max(1, len(points) - min(SIZES) + 1), PIECE):
        yield points[at : at + PIECE + max(SIZES) - 1]


def features(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's n-grams."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    found = [np.unique(gram_hashes(part, size)) for part in pieces(code_points(text)) for size in SIZES]
    return np.unique(np.concatenate(found))


@dataclass
class ToxicityModel:
    """Known n-grams (ascending hashes), their weights (the log-count ratios included), and the intercept."""

    grams: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self):
        self.slots = np.zeros(1 << SLOT_BITS, dtype=bool)
        self.slots[self.grams >> U(64 - SLOT_BITS)] = True

    def known(self, text: str | None) -> np.ndarray:
        """Places of the text's known n-grams, each once."""
        if not text or not len(self.grams):
            return np.zeros(0, dtype=np.int64)
        found = []
        for part in pieces(code_points(text)):
            for size in SIZES:
                hashes = gram_hashes(part, size)
                hashes = hashes[self.slots[hashes >> U(64 - SLOT_BITS)]]
                at = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
                found.append(np.unique(at[self.grams[at] == hashes]))
        return np.unique(np.concatenate(found))

    def score(self, text: str | None) -> float:
        return probability(self.intercept + float(self.weights[self.known(text)].sum()))


def probability(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(starts: np.ndarray, at: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression over features times their ratios, by accelerated gradient steps; weights of the bare features and the intercept.

    Row i has the features at[starts[i]:starts[i + 1]], places in `ratios`.
    """
    share = weight / weight.sum()
    columns = np.argsort(at, kind="stable").astype(np.int32)
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), np.diff(starts))[columns]
    firsts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(ratios)))])

    def sums(values: np.ndarray, places: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Of values[places] between each two edges."""
        out, some = np.zeros(len(edges) - 1), np.flatnonzero(np.diff(edges))
        for lo in range(0, len(some), FIT_ROWS):
            part = some[lo : lo + FIT_ROWS]
            out[part] = np.add.reduceat(values[places[edges[part[0]] : edges[part[-1] + 1]]], edges[part] - edges[part[0]])
        return out

    # the mean loss curves by a quarter of the weighted mean of the rows' squared lengths at most
    curve = 0.25 * float((share * (1 + sums(ratios**2, at, starts))).sum()) + PENALTY
    w, b = np.zeros(len(ratios)), float(np.log((share @ toxic) / (share @ (1 - toxic))))
    w_ahead, b_ahead, t = w, b, 1.0
    for _ in range(STEPS):
        off = share * (probability(b_ahead + sums(ratios * w_ahead, at, starts)) - toxic)
        slope = ratios * sums(off, row, firsts) + PENALTY * w_ahead
        w_next, b_next, t_next = w_ahead - slope / curve, b_ahead - off.sum() / curve, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (t - 1) / t_next
        w_ahead, b_ahead = w_next + ahead * (w_next - w), b_next + ahead * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w * ratios, b


def in_holdout(id_column: Column, parts: int = 5, part: int = 0) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, sample_rows: int, label_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of the sample, each once, and how many labelled rows each label has. documents: (id, text); labels: (id, toxic)."""
    count = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    total = max(1, sum(count.values()))
    share = {t: min(1.0, max(label_rows / n, sample_rows / total)) for t, n in count.items()}
    bound = F.when(F.col("toxic") == 1, int(share.get(1, 1.0) * PLACES)).otherwise(int(share.get(0, 1.0) * PLACES))
    chosen = labels.where(F.pmod(F.xxhash64("id"), F.lit(PLACES)) < bound)
    # bounded by the sample, so that no text but a chosen one moves
    return documents.join(F.broadcast(chosen), "id").select("text", "toxic").distinct(), count


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, label_rows: int = LABEL_ROWS) -> ToxicityModel:
    """Fit on labelled rows outside the holdout (crc32 of the id's text, mod 5, is 0)."""
    spark = documents.sparkSession
    ship_package(spark)
    marks = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].cast("int").alias("toxic"))
    marks = marks.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_holdout(F.col("id")))
    texts = documents.select(documents[f"`{id_col}`"].alias("id"), documents[f"`{text_col}`"].alias("text"))
    sample, count = labelled_sample(texts, marks, sample_rows, label_rows)
    total = sum(count.values())
    scratch = Scratch(spark, "toxicity")
    sample = scratch.keep(sample, "sample")
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(size) < 2:
        odds = count.get(1, 0) / max(1, total)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(odds, 1e-9) / max(1 - odds, 1e-9))))
    ratio = F.log((F.col("toxic") + 1) / (size[1] + 2)) - F.log((F.col("clean") + 1) / (size[0] + 2))
    error = F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    counted = gram_counts(sample).groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    known = counted.select("gram", ratio.alias("ratio"), error.alias("error")).where(F.abs("ratio") > DEVIATIONS * F.col("error")).select("gram", "ratio").toArrow()
    grams = known["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, ratios = grams[order], known["ratio"].to_numpy()[order]
    rows = known_grams(sample, ToxicityModel(grams, ratios, 0.0))
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(rows["places"]).to_numpy())])
    places = pc.list_flatten(rows["places"]).to_numpy()
    toxic = rows["toxic"].to_numpy().astype(float)
    weight = np.where(toxic == 1, count[1] / size[1], count[0] / size[0])
    weights, intercept = fit(starts, places, toxic, weight, ratios)
    return ToxicityModel(grams, weights, intercept)


def gram_counts(sample: DataFrame) -> DataFrame:
    """gram, toxic and clean texts that have it, of a few texts a row."""

    def table(found: list[np.ndarray], marks: list[int]) -> Iterator[pa.RecordBatch]:
        grams, place = np.unique(np.concatenate(found), return_inverse=True)
        mark = np.repeat(np.array(marks, dtype=np.int64), [len(x) for x in found])
        toxic = np.bincount(place, mark, minlength=len(grams)).astype(np.int64)
        clean = np.bincount(place, minlength=len(grams)) - toxic
        for at in range(0, len(grams), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(grams[part].view(np.int64)), pa.array(toxic[part]), pa.array(clean[part])], ["gram", "toxic", "clean"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        marks: list[int] = []
        held = 0
        for batch in batches:
            for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.append(features(text))
                marks.append(mark)
                held += len(found[-1])
                if held > HELD_GRAMS:
                    yield from table(found, marks)
                    found, marks, held = [], [], 0
        if found:
            yield from table(found, marks)

    return sample.select("text", "toxic").mapInArrow(arrow_text.tidied(count), "gram long, toxic long, clean long")


def known_grams(sample: DataFrame, model: ToxicityModel) -> pa.Table:
    """places of the known n-grams, and the label, of each text of the sample."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [shared.value.known(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.list_(pa.int32())), batch.column(1)], ["places", "toxic"])

    return sample.select("text", "toxic").mapInArrow(arrow_text.tidied(find), "places array<int>, toxic int").toArrow()


def score(documents: DataFrame, model: ToxicityModel, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """row (a struct of the carried columns) and score of each document."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded as the sample is

    @arrow_udf("double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            yield pa.array([shared.value.score(x) for x in texts.to_pylist()], pa.float64())
        arrow_text.tidy()

    carried = F.struct(*(documents[f"`{c}`"] for c in (documents.columns if carry is None else carry)))
    return documents.select(carried.alias("row"), predict(documents[f"`{text_col}`"]).alias("score"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), carry=["doc_id"])
    doc_id = F.col("row.doc_id")
    return found.select(doc_id.alias("doc_id"), in_holdout(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
