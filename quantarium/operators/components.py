"""Principal components from merged sums of products, and kernel density on a grid by two passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quantarium.session import ship_package

#: Dimensions up to which the products (their square) come to the driver.
MOST_DIMENSIONS = 2048
STEPS = 1000
PRECISE = 1e-12


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def moments(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and covariances of the vectors without nulls; each task adds its own products, Spark adds the tasks'. Vectors of several lengths are an error."""
    ship_package(df.sparkSession)
    rows = df.select(F.col(f"`{vector}`").cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    low, high = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if low is None:
        return 0, np.zeros(0), np.zeros((0, 0))
    if low != high or high > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {low} to {high} dimensions; one number, {MOST_DIMENSIONS} at most, is needed")
    d = high

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d), np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, sums, products = n + len(x), sums + x.sum(axis=0), products + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([np.concatenate([sums, products.ravel()])], pa.list_(pa.float64()))], ["n", "sums"])

    parts = rows.mapInArrow(add, "n long, sums array<double>")
    told = parts.select("n", F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).toArrow()
    flat = np.zeros(d + d * d)
    flat[told["at"].to_numpy()] = told["x"].to_numpy()
    n = told["n"][0].as_py()
    mean = flat[:d] / n
    return n, mean, (flat[d:].reshape(d, d) - n * np.outer(mean, mean)) / max(1, n - 1)


def principal(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest variances and their directions (rows, the largest entry positive), by orthogonal iteration."""
    d = len(covariance)
    k = min(k, d)
    wide = min(d, 2 * k + 4)  # a wider space settles faster
    basis, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(1)).normal(size=(d, wide)))
    before = np.zeros(k)
    for _ in range(STEPS):
        basis, _ = np.linalg.qr(covariance @ basis)
        small = basis.T @ covariance @ basis
        values, turn = np.linalg.eigh((small + small.T) / 2)
        basis, values = basis @ turn[:, ::-1], values[::-1]
        if np.abs(values[:k] - before).max(initial=0) <= PRECISE * max(1e-300, abs(values[0])):
            break
        before = values[:k].copy()
    directions = basis[:, :k].T
    return values[:k], directions * np.sign(directions[np.arange(k), np.abs(directions).argmax(axis=1)])[:, None]


def projected(df: DataFrame, vector: str, mean: np.ndarray, directions: np.ndarray) -> Column:
    """The vector's coordinates along the directions; null for null."""

    @arrow_udf("array<double>")
    def along(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out: list = [None] * len(column)
            some = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                for i, row in zip(some, (_matrix(column.drop_null(), len(mean)) - mean) @ directions.T):
                    out[i] = row
            yield pa.array(out, pa.list_(pa.float64()))

    return along(df[f"`{vector}`"].cast("array<double>"))


def density(points: DataFrame, x: str, y: str, bins: int = 32, by: list[str] | None = None) -> DataFrame:
    """by, i, j, n and density of each cell of a grid over all points: a Gaussian kernel of Scott's width, over counts by cell.

    One pass finds extents and widths, one counts by cell; what is smoothed, along one axis and then the other, is the grid.
    A group without spread along an axis, or with one point, has no density (null). Null coordinates are no points.
    """
    by = by or []
    rows = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ends = rows.agg(*(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("low", F.min), ("high", F.max)))).first()
    step = {c: ((ends[f"high_{c}"] - ends[f"low_{c}"]) / bins if ends[f"low_{c}"] is not None else 0.0) or 1.0 for c in "xy"}
    cell = lambda c: F.least(F.floor((F.col(c) - F.lit(ends[f"low_{c}"])) / step[c]), F.lit(bins - 1)).cast("int")
    scott = F.pow(F.count("*"), F.lit(-1.0 / 6))
    widths = rows.groupBy(*by).agg(F.count("*").alias("all"), *((F.stddev_samp(c) * scott / step[c]).alias(f"w{c}") for c in "xy"))
    counts = rows.groupBy(*by, cell("x").alias("i"), cell("y").alias("j")).agg(F.count("*").alias("n"))
    places = F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    kernel = lambda a, b, w: F.exp(-0.5 * F.pow((F.col(a) - F.col(b)) / F.col(w), F.lit(2.0)))
    told = counts.join(widths, by) if by else counts.crossJoin(F.broadcast(widths))  # without groups it is one row
    told = told.where("wx > 0 AND wy > 0")
    along = told.withColumn("ti", places).groupBy(*by, "ti", "j", "all", "wx", "wy").agg(F.sum(F.col("n") * kernel("ti", "i", "wx")).alias("s"))
    both = along.withColumn("tj", places).groupBy(*by, F.col("ti").alias("i"), F.col("tj").alias("j"), "all", "wx", "wy").agg(F.sum(F.col("s") * kernel("tj", "j", "wy")).alias("s"))
    area = 2 * math.pi * step["x"] * step["y"]
    smooth = both.select(*by, "i", "j", (F.col("s") / (area * F.col("all") * F.col("wx") * F.col("wy"))).alias("density"))
    return smooth.join(counts, [*by, "i", "j"], "full").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
