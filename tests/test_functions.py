from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from quantarium.functions import numeric, text


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw", ["IC 50", "ic_50", "IC/50", "IC.50", "IC 50", " ic50 "])
def test_harmonize(spark, raw):
    assert one(spark, text.harmonize(F.lit(raw))) == "IC50"


@pytest.mark.parametrize(("raw", "key"), [("BAA-1605", "BAA1605"), ("ATCC BAA1605", "BAA1605"), ("NCTC 25922", "25922"), ("WHO-X", "X"), ("ATCC", "ATCC"), ("ccmfoo", "CCMFOO"), ("nan", ""), (None, "")])
def test_strain_key(spark, raw, key):
    assert one(spark, text.strain_key(F.lit(raw).cast("string"))) == key


def test_prefix_key_keeps_collections_apart(spark):
    assert one(spark, text.prefix_key(F.lit("LMG 17978"))) != one(spark, text.prefix_key(F.lit("ATCC 17978")))


@pytest.mark.parametrize(("raw", "out"), [(">=", ">"), (">>", ">"), ("<=", "<"), ("~", "="), (None, "="), ("≈", None)])
def test_relation(spark, raw, out):
    assert one(spark, text.relation(F.lit(raw).cast("string"))) == out


@pytest.mark.parametrize(("value", "out"), [(0.0, 9), (1.0, 6), (1e9, 1), (None, None), (-1.0, None)])
def test_pscale(spark, value, out):
    assert one(spark, numeric.pscale(F.lit(value).cast("double"))) == out


def test_unit_formula(spark):
    rules = [("ug.mL-1", "umol.L-1", "standard_value*1000/molecular_weight"), ("h", "s", "standard_value*(60*60)")]
    for v, u, w, out in ((10.0, "ug.mL-1", 500.0, (20.0, "umol.L-1")), (2.0, "h", 1.0, (7200.0, "s")), (5.0, "furlong", 1.0, (5.0, None)), (5.0, "ug.mL-1", 0.0, (None, "umol.L-1"))):
        value, unit = numeric.convert(F.lit(v), F.lit(u), F.lit(w), rules)
        assert (one(spark, value), one(spark, unit)) == out


@pytest.mark.parametrize("bad", ["__import__('os')", "standard_value**2", "(standard_value", "x", "", "1 2"])
def test_unit_formula_refuses(spark, bad):
    with pytest.raises(ValueError):
        numeric.formula(bad, F.lit(1.0), F.lit(1.0))


def test_thresholds(spark):
    array = numeric.thresholds(F.lit("5;10;20"), F.lit(-1))
    assert one(spark, array) == [20, 10, 5]
    assert one(spark, numeric.reference_threshold(array, F.lit("umol.L-1"))) == 10
    assert one(spark, numeric.reference_threshold(numeric.thresholds(F.lit("50;75;90"), F.lit(1)), F.lit("%"))) == 50
    assert one(spark, numeric.reference_threshold(F.array(F.lit(7.0)), F.lit("x"))) == 7
    assert one(spark, numeric.reference_threshold(F.expr("cast(array() as array<double>)"), F.lit("x"))) is None
    assert tuple(one(spark, numeric.threshold_levels(F.array(F.lit(1.0))))) == (None, 1.0, None)
    assert tuple(one(spark, numeric.threshold_levels(F.array(F.lit(1.0), F.lit(2.0))))) == (1.0, None, 2.0)
    assert one(spark, numeric.formatted(F.array(F.lit(0.5), F.lit(None).cast("double")))) == "0.50;nan"


@pytest.mark.parametrize(("a", "b", "out"), [(0, 0, 0), (1, 0, 1), (-1, 0, -1), (1, 1, 1), (1, -1, None)])
def test_merge_flags(spark, a, b, out):
    assert one(spark, numeric.merge_flags(F.lit(a), F.lit(b))) == out


def test_binarize_boundary(spark):
    assert one(spark, numeric.binarize(F.lit(5.0), F.lit(5.0), F.lit(1))) == one(spark, numeric.binarize(F.lit(5.0), F.lit(5.0), F.lit(-1))) == 1


def test_keys(spark):
    key = text.encode_key(F.lit(1), F.lit("MIC"), F.lit(None).cast("string"))
    assert one(spark, key) == "1|MIC|"
    assert [one(spark, c) for c in text.decode_key(key, ["a", "b", "c"])] == ["1", "MIC", None]
    assert one(spark, text.without_last_token(F.lit("a_b_c"))) == "a_b"
    assert one(spark, text.species_code(F.lit("Escherichia coli"))) == "ecoli"


def test_categories(spark):
    assert one(spark, text.first_category(F.lit("insufficient compounds; active ratio"), text.REASONS)) == "too_few_compounds"
    assert one(spark, text.first_category(F.lit("?"), text.REASONS)) == "other"
    assert one(spark, text.reason_group(F.lit("insufficient_positives_x"))) == "Too few positives"
    assert one(spark, text.target_class(F.lit("unchecked"), F.lit(" organism "))) == "ORGANISM"
    assert one(spark, text.target_class(F.lit("ORGANISM"), F.lit(None).cast("string"))) == "DISCARDED"


def test_axes(spark):
    assert math.isclose(one(spark, numeric.value_to_axis(numeric.axis_to_value(F.lit(0.4)))), 0.4)
    assert one(spark, numeric.clipped_counts(F.create_map(F.lit(1), F.lit(300)), 3)) == [0, 127, 0]
