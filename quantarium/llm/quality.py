"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Measures of each whole text (symbols, capitals, repeated lines, repeated word windows, as shares in
thousandths) are compared with cutoffs. Labelled documents are halved by a hash of their id. On the
tuning half, a family of cutoff vectors is read off the good documents: one step of STEPS lets that
share of them pass each measure, from all of them (reject nothing met) downwards, so later steps
reject all that earlier ones do. On the holdout half each step is tested in turn: with k of n good
documents rejected, the exact binomial tail P(X <= k) at a false rejection rate RISK must be at most
DELTA / strata (Bonferroni over strata; steps are tested in a fixed order up to the first failure,
which needs no further correction). So with probability 1 - DELTA no stratum loses more than RISK of
its good documents. Of the steps that hold, the one that parts good from bad best on the tuning half
is used, the most lenient of equals.

Histograms of at most 1001 bins a stratum and measure, counts a stratum and step: nothing else is
gathered, whatever the number of documents.

Defined results: null texts have no words and fail the base rule; strata without labels or with too
few have no cutoffs; labels that contradict each other count as bad; labels of unknown ids count
nowhere; repeated documents are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quantarium.session import Scratch

RISK = 0.02
DELTA = 0.05
STEPS = (1.0, 0.9995, 0.999, 0.9985, 0.998, 0.997, 0.996, 0.995, 0.993, 0.99, 0.985, 0.98)
MEASURES = ("symbols", "capitals", "lines", "repeats")
MIN_WORDS = 50
_WHITE = r"[\x20\x09-\x0D]+"


def measure(documents: DataFrame, text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns of `keep` and n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words."""
    keep = keep or {}
    df = documents.select(*(c.alias(f"k_{i}") for i, c in enumerate(keep.values())), F.coalesce(documents[text_col].cast("string"), F.lit("")).alias("text"))
    kept = [f"k_{i}" for i in range(len(keep))]
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        *kept, F.array_remove(F.split("text", _WHITE), "").alias("words"), lines.alias("lines"),
        F.expr(r"regexp_count(text, '[#*$%&|<>]')").cast("long").alias("n_symbols"), F.expr(r"regexp_count(text, '\\p{Lu}')").cast("long").alias("n_capitals"),
    )
    df = df.select(
        *kept, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 4, F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).alias("windows"),
    )
    # most texts repeat no window: a sort of plain numbers tells; only the others' positions are sorted too
    df = df.withColumn("distinct", F.coalesce(F.size(F.array_distinct("windows")), F.lit(-1)))
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("pairs", F.when(F.col("distinct") < F.size("windows"), pairs))
    repeated = F.expr("filter(pairs, (x, i) -> x.h = get(pairs, i - 1).h OR x.h = get(pairs, i + 1).h)")
    df = df.withColumn("places", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    # each place adds the words of its window that the place before it does not have
    covered = F.expr("aggregate(places, named_struct('at', -3, 'n', 0L), (a, x) -> named_struct('at', x, 'n', a.n + least(3, x - a.at)), a -> a.n)")
    names = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines"]
    return df.select(*(F.col(k).alias(n) for k, n in zip(kept, keep)), *names, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def shares(prefix: str = "") -> dict[str, Column]:
    """The measures as whole thousandths, 0 to 1000."""

    def share(a: str, b: str) -> Column:
        return F.least(F.lit(1000), F.floor(F.lit(1000) * F.col(prefix + a) / F.greatest(F.col(prefix + b), F.lit(1)))).cast("int")

    return {"symbols": share("n_symbols", "word_chars"), "capitals": share("n_capitals", "word_chars"), "lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words")}


def binomial_tail(k: str, n: str, rate: float) -> Column:
    """P(X <= k) for X binomial of n trials at rate, summed term by term in logarithms; 1 where k is past the mean."""
    p = f"{rate!r}D"  # a plain literal would be a decimal
    term = f"a.t + ln(({n} - j + 1) / j) + ln({p} / (1 - {p}))"
    total = f"greatest(a.s, {term}) + ln(1 + exp(-abs(a.s - ({term}))))"
    first = f"{n} * ln(1 - {p})"
    return F.expr(
        f"CASE WHEN {k} >= {n} * {p} THEN 1D ELSE aggregate(slice(sequence(0L, {k}), 2, cast({k} as int)), named_struct('t', {first}, 's', {first}), "
        f"(a, j) -> named_struct('t', {term}, 's', {total}), a -> exp(a.s)) END"
    )


def learn_cutoffs(labelled: DataFrame, scratch: Scratch, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, a cutoff each measure (or null), step, and the evidence, from rows of id, stratum, good and measures."""
    half = F.substring(F.md5(F.concat(F.lit("half"), F.col("id").cast("string"))), 1, 1)
    rows = labelled.withColumn("tuning", half < "8")
    entries = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.col(m).alias("bin")) for m in MEASURES))).alias("e")
    bins = rows.where("tuning AND good").select("stratum", entries).groupBy("stratum", "e.m", "e.bin").count()
    each = Window.partitionBy("stratum", "m")
    bins = bins.withColumn("below", F.sum("count").over(each.orderBy("bin"))).withColumn("all", F.sum("count").over(each))
    cuts = bins.groupBy("stratum", "m").agg(F.array(*(F.min(F.when(F.col("below") >= F.lit(s) * F.col("all"), F.col("bin"))) for s in STEPS)).alias("cuts"))
    cuts = cuts.groupBy("stratum").agg(*(F.max(F.when(F.col("m") == m, F.col("cuts"))).alias(f"{m}_cuts") for m in MEASURES))
    cuts = scratch.keep(cuts, "cuts")
    level = F.least(*(F.expr(f"size(filter({m}_cuts, c -> c >= {m}))") for m in MEASURES))
    levels = rows.join(cuts, "stratum").groupBy("stratum", "tuning", "good", level.alias("level")).count()
    step = F.explode(F.sequence(F.lit(0), F.lit(len(STEPS) - 1))).alias("step")
    out = F.col("level") <= F.col("step")

    def total(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("count"))), F.lit(0))

    tests = levels.select("*", step).groupBy("stratum", "step").agg(
        total(~F.col("tuning") & F.col("good") & out).alias("k"), total(~F.col("tuning") & F.col("good")).alias("n"),
        total(F.col("tuning") & F.col("good") & out).alias("fp"), total(F.col("tuning") & F.col("good")).alias("p"),
        total(F.col("tuning") & ~F.col("good") & out).alias("tn"), total(F.col("tuning") & ~F.col("good")).alias("q"),
    )
    strata = cuts.count()
    tests = tests.withColumn("tail", binomial_tail("k", "n", risk)).withColumn("holds", (F.col("n") > 0) & (F.col("tail") <= delta / max(1, strata)))
    tests = tests.withColumn("valid", F.min("holds").over(Window.partitionBy("stratum").orderBy("step")))
    gain = F.col("tn") / F.greatest("q", F.lit(1)) - F.col("fp") / F.greatest("p", F.lit(1))
    best = tests.where("valid").groupBy("stratum").agg(F.max_by(F.struct("step", "k", "n", "tail"), F.struct(gain.alias("gain"), (-F.col("step")).alias("lenient"))).alias("best"))
    chosen = cuts.join(best, "stratum", "left")
    return chosen.select("stratum", *(F.get(f"{m}_cuts", F.col("best.step")).alias(f"max_{m}") for m in MEASURES), "best.step", "best.k", "best.n", "best.tail")


def assess(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", good_col: str = "quality", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """id, stratum, measures, base_failed, over (names of measures past their cutoff), kept."""
    scratch = Scratch(documents.sparkSession, "quality")
    stratum = F.coalesce(documents[stratum_col].cast("string"), F.lit("\x00"))
    measured = scratch.keep(measure(documents, text_col, {"id": documents[id_col], "stratum": stratum}).select("*", *(c.alias(m) for m, c in shares().items())), "measures")
    truth = labels.select(labels[id_col].alias("id"), labels[good_col].alias("good")).dropna().groupBy("id").agg(F.min(F.col("good").cast("int")).alias("good"))
    labelled = measured.join(truth, "id").select("id", "stratum", (F.col("good") == 1).alias("good"), *MEASURES)
    cutoffs = scratch.keep(learn_cutoffs(scratch.keep(labelled, "labelled"), scratch, risk, delta), "cutoffs")
    judged = measured.join(cutoffs.select("stratum", *(f"max_{m}" for m in MEASURES)), "stratum", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    over = F.array_compact(F.array(*(F.when(F.col(m) > F.col(f"max_{m}"), F.lit(m)) for m in MEASURES)))
    judged = judged.withColumn("base_failed", failed).withColumn("over", over).withColumn("kept", ~failed & (F.size(over) == 0))
    return judged.drop(*(f"max_{m}" for m in MEASURES)).withColumnRenamed("id", id_col)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = assess(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
