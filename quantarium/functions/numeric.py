"""Column expressions over numbers and arrays: units, scales, thresholds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(standard_value|molecular_weight|\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|[-+*/()])")


def formula(text: str, value: Column, weight: Column) -> Column:
    """A unit formula as a Column: + - * / and brackets over standard_value, molecular_weight and numbers.

    Anything else is an error; a division by zero is null.
    """
    tokens, at = [], 0
    while at < len(text.rstrip()):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"not a unit formula: {text!r}")
        tokens.append(m[1])
        at = m.end()
    place = 0

    def take(*wanted: str) -> str | None:
        nonlocal place
        if place < len(tokens) and (not wanted or tokens[place] in wanted):
            place += 1
            return tokens[place - 1]
        return None

    def atom() -> Column:
        t = take()
        if t == "(":
            inner = terms()
            if not take(")"):
                raise ValueError(f"a bracket is open: {text!r}")
            return inner
        if t == "-":
            return -atom()
        if t is None or t in "+*/)":
            raise ValueError(f"not a unit formula: {text!r}")
        return value if t == "standard_value" else weight if t == "molecular_weight" else F.lit(float(t))

    def factors() -> Column:
        left = atom()
        while op := take("*", "/"):
            right = atom()
            left = left * right if op == "*" else F.try_divide(left, right)
        return left

    def terms() -> Column:
        left = factors()
        while op := take("+", "-"):
            right = factors()
            left = left + right if op == "+" else left - right
        return left

    out = terms()
    if place != len(tokens):
        raise ValueError(f"not a unit formula: {text!r}")
    return out


def convert(value: Column, unit: Column, weight: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(value, unit) by rules of (unit, final unit, formula); an unknown unit keeps its value and loses its unit.

    One branch for each distinct formula, not for each unit.
    """
    by_formula: dict[str, list[str]] = {}
    for u, _, f in rules:
        by_formula.setdefault(f.replace(" ", ""), []).append(u)
    new = F
    for f, units in by_formula.items():
        new = new.when(unit.isin(units), formula(f, value, weight))
    finals = F.create_map(*(F.lit(x) for u, final, _ in rules for x in (u, final)))
    return (new.otherwise(value) if by_formula else value), F.try_element_at(finals, unit)


def pscale(micromolar: Column) -> Column:
    """-log10 of the molar value, within 1 to 9; zero counts as 1e-10 micromolar, null and negative are null."""
    p = 6 - F.log10(F.when(micromolar == 0, F.lit(1e-10)).otherwise(micromolar))
    return F.when(micromolar >= 0, F.greatest(F.lit(1.0), F.least(F.lit(9.0), p)))


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def binarize(value: Column, cutoff: Column, direction: Column) -> Column:
    """1 where the value reaches the cutoff in the active direction."""
    return F.when(direction == 1, value >= cutoff).when(direction == -1, value <= cutoff).cast("int")


def merge_flags(a: Column, b: Column, strict: bool = False) -> Column:
    """1 or -1 if either flag says so, else 0; flags of both signs are null, or an error if strict."""
    both = (F.least(a, b) == -1) & (F.greatest(a, b) == 1)
    clash = F.raise_error(F.lit("a row has an active and an inactive flag")).cast("int") if strict else F.lit(None).cast("int")
    return F.when(both, clash).when(F.greatest(a, b) == 1, 1).when(F.least(a, b) == -1, -1).otherwise(0)


def thresholds(c: Column, direction: Column) -> Column:
    """`5;10;20` as numbers, most lenient first."""
    numbers = F.transform(F.split(c, ";"), lambda x: F.trim(x).cast("double"))
    return F.when(direction == -1, F.reverse(numbers)).otherwise(numbers)


def reference_threshold(array: Column, unit: Column) -> Column:
    """Element 0 for %, else element 1; the last where there is none; null for an empty list."""
    place = F.when(unit.eqNullSafe(F.lit("%")), 0).otherwise(1)
    return F.when(F.size(array) > 0, F.coalesce(F.get(array, place), F.element_at(array, -1)))


def threshold_levels(array: Column) -> Column:
    """A struct low, middle, high: one threshold is middle, two are low and high, of more the first, second and last."""
    n = F.size(array)
    return F.struct(
        F.when(n > 1, F.get(array, 0)).alias("low"), F.when(n == 1, F.get(array, 0)).when(n > 2, F.get(array, 1)).alias("middle"),
        F.when(n > 1, F.element_at(array, -1)).alias("high"),
    )


def right_closed_bin(c: Column, edges: list[float]) -> Column:
    """Number of the interval (edge i, edge i + 1] that holds the value, or null."""
    out = F
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        out = out.when((c > a) & (c <= b), i)
    return out


def formatted(array: Column, digits: int = 2, missing: str = "nan") -> Column:
    """Numbers as text, joined by ;."""
    return F.array_join(F.transform(array, lambda x: F.when(x.isNull(), F.lit(missing)).otherwise(F.format_string(f"%.{digits}f", x))), ";")


def axis_to_value(c: Column) -> Column:
    return F.pow(F.lit(10.0), 5 * c)


def value_to_axis(c: Column) -> Column:
    return F.log10(c) / 5


def clipped_counts(counts: Column, width: int) -> Column:
    """A map of place to count as a dense array of width bytes, at most 127 each."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.least(F.coalesce(F.try_element_at(counts, i), F.lit(0)), F.lit(127)).cast("tinyint"))
