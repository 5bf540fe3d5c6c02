"""Similarity of dense vectors of fragments; structures.py makes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tanimoto(a: Column, b: Column) -> Column:
    """Shared over all places that are set in two vectors."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: ((x > 0) & (y > 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    some = F.aggregate(F.zip_with(a, b, lambda x, y: ((x > 0) | (y > 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.try_divide(both, some)


#: References that every row is compared with; more are an error, as each is held in every task.
REFERENCES = 1_000


def to_references(df: DataFrame, vector: str, references: DataFrame, name: str, most: int = REFERENCES) -> DataFrame:
    """Every row of df with every reference: the reference's name and the similarity of their vectors.

    references: name and a vector under the same column names as given; they are one array, computed once
    and then a constant of the plan, with an error above `most` of them.
    """
    few = references.select(F.struct(F.col(name).alias("name"), F.col(vector).alias("vector")).alias("r")).limit(most + 1)
    bound = F.when(F.count("*") <= most, F.collect_list("r")).otherwise(F.raise_error(F.lit(f"more than {most} references")))
    rest = [c for c in df.columns if c != vector]
    rows = df.select(*rest, vector, F.explode(few.agg(bound.alias("all")).scalar()).alias("reference"))
    return rows.select(*rest, F.col("reference.name").alias(name), tanimoto(F.col(vector), F.col("reference.vector")).alias("similarity"))
