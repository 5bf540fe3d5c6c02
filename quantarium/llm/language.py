"""Language ID by word-first backoff.

A word that the training texts hold adds its log frequency in each language. An unseen word is
tiled from the left by the longest known character n-gram, from LONGEST characters (with word
boundaries) down to one; each tile adds its log frequency in each language. The language with the
highest sum, the prior included, is predicted; the score is its share after a softmax of the sums
divided by max(1, words / EVIDENCE), so long texts don't all score 1.

Training fits on a bounded sample: of each label, the labelled rows with the smallest hashes of their
ids, about its share of SAMPLE_ROWS but LABEL_ROWS at least, or all if it has fewer (documented
bounds, the same at every corpus size), and of each the whole text. The prior is of all labelled rows.
Words and n-grams met once are not known. Only text and the label are learnt from.

Defined results: null texts and texts without letters are `und` with score 0, as is everything if
no row is labelled; ties go to the label first in order; repeated rows get equal predictions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quantarium.llm import arrow_text
from quantarium.session import ship_package, small_reads

SAMPLE_ROWS = 6_000
LABEL_ROWS = 1_000
#: Values of the ids' hash that the sample tells apart.
PLACES = 1 << 40
LONGEST = 5
EVIDENCE = 8
UNKNOWN = "und"
#: Words whose scores a worker holds at once.
HELD_WORDS = 150_000
WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    words = WORDS.findall(text.lower()) if text else []
    if words and not any(c.isalpha() for w in islice(words, 1) for c in w):
        words = [w for w in words if any(map(str.isalpha, w))]
    return words


def ngrams(word: str, longest: int = LONGEST) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies: words and n-grams, each with a row of one value a language. The driver holds arrays only; a worker that looks words up makes the dictionaries."""

    languages: list[str]
    prior: np.ndarray
    words: pa.Array
    word_logs: np.ndarray
    grams: pa.Array
    gram_logs: np.ndarray

    @staticmethod
    def of(languages: list[str], documents: list[int], words: pa.Array | list[str], word_counts: np.ndarray, grams: pa.Array | list[str], gram_counts: np.ndarray) -> LanguageModel:
        """From counts a language (columns) of words and n-grams (rows)."""
        words, grams = (x if isinstance(x, pa.Array) else pa.array(x, pa.string()) for x in (words, grams))
        prior = np.log(np.array(documents, dtype=float) / max(1, sum(documents)))
        logs = np.zeros(gram_counts.shape, dtype=np.float32)
        sizes = pc.utf8_length(grams).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            logs[sizes == size] = LanguageModel._logs(gram_counts[sizes == size])
        return LanguageModel(languages, prior, words, LanguageModel._logs(word_counts), grams, logs)

    @staticmethod
    def _logs(counts: np.ndarray) -> np.ndarray:
        """Add-half smoothed log relative frequencies, a language at a time."""
        logs = np.zeros(counts.shape, dtype=np.float32)
        for i in range(counts.shape[1]):
            column = counts[:, i] + 0.5
            logs[:, i] = np.log(column / max(column.sum(), 1))
        return logs

    @cached_property
    def word_rows(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    @cached_property
    def gram_rows(self) -> dict[str, int]:
        return {g: i for i, g in enumerate(self.grams.to_pylist())}

    def score(self, word: str) -> np.ndarray:
        found = self.word_rows.get(word)
        if found is not None:
            return self.word_logs[found]
        padded, i = f"^{word}$", 0
        total = np.zeros(len(self.languages), dtype=np.float32)
        while i < len(padded):
            for n in range(min(LONGEST, len(padded) - i), 0, -1):
                found = self.gram_rows.get(padded[i : i + n])
                if found is not None:
                    total = total + self.gram_logs[found]
                    break
            i += n
        return total


class Predictor:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.rows: dict[str, int] = {}
        self.table = np.zeros((HELD_WORDS, max(1, len(model.languages))), dtype=np.float32)

    def _row(self, word: str) -> int:
        if len(self.rows) >= HELD_WORDS:
            self.rows.clear()
        self.rows[word] = i = len(self.rows)
        self.table[i] = self.model.score(word)
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        total = self.model.prior.copy()
        for at in range(0, len(words), HELD_WORDS // 2):
            part = words[at : at + HELD_WORDS // 2]
            if len(self.rows) + len(part) > HELD_WORDS:
                self.rows.clear()
            held, row = self.rows.get, self._row
            total += self.table[[i if (i := held(w)) is not None else row(w) for w in part]].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        shares = np.exp((total - total[best]) / max(1.0, len(words) / EVIDENCE))
        return self.model.languages[best], float(1 / shares.sum())


def in_holdout(id_column: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, label_rows: int = LABEL_ROWS) -> LanguageModel:
    """Fit on labelled rows outside the holdout (crc32 of the id's text, mod 4, is 2)."""
    ship_package(documents.sparkSession)
    small_reads(documents.sparkSession)
    rows = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"), documents[lang_col].cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_holdout(F.col("id"), 4, 2))
    documents_ = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    total, languages = sum(documents_.values()), sorted(documents_)
    places = {x: i for i, x in enumerate(languages)}
    sample = rows
    if total > sample_rows:
        bounds = [int(min(1.0, max(label_rows / n, sample_rows / total)) * PLACES) for n in documents_.values()]
        # an Arrow table needs no Python workers, of which a list of rows would start more on each executor
        bounds = documents.sparkSession.createDataFrame(pa.table({"lang": pa.array(list(documents_), pa.string()), "bound": pa.array(bounds, pa.int64())}))
        sample = rows.join(F.broadcast(bounds), "lang").where(F.pmod(F.xxhash64("id"), F.lit(PLACES)) < F.col("bound"))

    def count(batches):
        words: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counter in words.items():
            grams: Counter = Counter()
            for w, n in counter.items():
                for g in ngrams(w):
                    grams[g] += n
            for kind, found in (("w", counter), ("g", grams)):
                out = list(found.items())
                for at in range(0, len(out), 100_000):
                    tokens, n = zip(*out[at : at + 100_000])
                    yield pa.RecordBatch.from_arrays([pa.array([places[lang]] * len(n), pa.int32()), pa.array([kind] * len(n)), pa.array(tokens, pa.string()), pa.array(n, pa.int64())], ["lang", "kind", "token", "n"])

    counted = sample.select("text", "lang").mapInArrow(arrow_text.tidied(count), "lang int, kind string, token string, n long")
    counted = counted.groupBy("kind", "token", "lang").agg(F.sum("n").alias("n"))
    kept = counted.groupBy("kind", "token").agg(F.collect_list(F.struct("lang", "n")).alias("n"), F.sum("n").alias("total"))
    # the sample's words and n-grams, bounded as it is, as arrays: as rows of Python they took 958 bytes each
    kept = kept.where("total > 1").orderBy("kind", "token").select("kind", "token", "n").toArrow()

    def table(kind: str) -> tuple[pa.Array, np.ndarray]:
        found = kept.filter(pc.equal(kept["kind"], kind))
        row = np.repeat(np.arange(len(found)), pc.list_value_length(found["n"]).to_numpy())
        each = pc.list_flatten(found["n"])
        counts = np.zeros((len(found), len(languages)), dtype=np.int64)
        counts[row, pc.struct_field(each, "lang").to_numpy()] = pc.struct_field(each, "n").to_numpy()
        return found["token"].combine_chunks(), counts

    model = LanguageModel.of(languages, [documents_[x] for x in languages], *table("w"), *table("g"))
    del kept
    arrow_text.tidy()
    return model


def identify(documents: DataFrame, model: LanguageModel, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """row (a struct of the carried columns), lang_pred and score of each document."""
    ship_package(documents.sparkSession)
    small_reads(documents.sparkSession)
    carry = documents.columns if carry is None else carry
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded as the sample is

    @arrow_udf("struct<lang_pred: string, score: double>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predictor = Predictor(shared.value)
        for texts in columns:
            found = [predictor.predict(x) for x in texts.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], ["lang_pred", "score"])
        arrow_text.tidy()

    df = documents.select(F.struct(*(documents[f"`{c}`"] for c in carry)).alias("row"), predict(documents[text_col]).alias("found"))
    return df.select("row", "found.*")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, train(docs), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), in_holdout(F.col("row.doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
