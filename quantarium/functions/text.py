"""Column expressions over text: keys, flags, categories, messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Acronyms of culture collections. A number follows those of the first row.
NUMBERED_COLLECTIONS = "ATCC DSMZ DSM NCTC NCIMB NCIB MTCC CIP CGMCC CPCC CCUG KCTC JCM NRRL NBRC NRBC CECT BCRC CGSC NCCP NCPF IFO KCCM LMG CCM CMCC CICC GIM".split()
LETTERED_COLLECTIONS = "WHO FDA".split()

#: Relation spellings and what they mean.
RELATIONS = {">": ">", ">=": ">", ">>": ">", "<": "<", "<=": "<", "<<": "<", "=": "=", "~": "="}

#: Reasons found in comments, first match wins.
REASONS = [
    ("selected", "Retained in final selection"),
    ("already_accepted", "already accepted"),
    ("non_organism", "non-ORGANISM target type|no curated target_chembl_id"),
    ("qualitative_only", "only qualitative data"),
    ("no_activity_data", "no activity data"),
    ("no_cutoff", "no expert cutoff defined"),
    ("too_few_compounds", "insufficient compounds"),
    ("too_few_positives", "insufficient positives|insufficient actives"),
    ("ratio_out_of_range", "active ratio"),
    ("insufficient_compatible", "insufficient compatible assays"),
    ("fractional_contribution", "insufficient fractional contribution"),
    ("group_qualified", "sole qualifying assay"),
    ("auroc_below", "below 0.70 threshold"),
    ("correlation", "high correlation"),
]

_SEPARATOR = r"[\s\-_./\\]"


def harmonize(c: Column) -> Column:
    """Upper case without blanks, underscores, dots and slashes; all Unicode white space counts."""
    return F.regexp_replace(F.upper(F.trim(c)), r"(?U)[_\s./\\]", "")


def _upper(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", ""))


def prefix_key(c: Column) -> Column:
    """Upper case without separators; '' for null, blank and 'nan'."""
    up = _upper(c)
    return F.when(up.isin("", "NAN"), F.lit("")).otherwise(F.regexp_replace(up, f"(?U){_SEPARATOR}", ""))


def strain_key(c: Column) -> Column:
    """prefix_key without a collection's acronym where a designator follows it."""
    up = _upper(c)
    numbered = "|".join(sorted(NUMBERED_COLLECTIONS, key=len, reverse=True))
    lettered = "|".join(LETTERED_COLLECTIONS)
    acronym = rf"\b(?:(?:{numbered})(?={_SEPARATOR}*(?:[A-Z]+{_SEPARATOR}*)?\d)|(?:{lettered})(?={_SEPARATOR}*[A-Z0-9])){_SEPARATOR}*"
    bare = F.regexp_replace(F.regexp_replace(up, f"(?U){acronym}", ""), f"(?U){_SEPARATOR}", "")
    return F.when(up.isin("", "NAN"), F.lit("")).when(bare == "", prefix_key(c)).otherwise(bare)


def relation(c: Column) -> Column:
    """One of < = >; null means =, unlisted spellings become null."""
    known = F.create_map(*(F.lit(x) for pair in RELATIONS.items() for x in pair))
    return F.when(c.isNull(), F.lit("=")).otherwise(F.try_element_at(known, F.trim(c)))


def lookup(c: Column, values: dict[str, str]) -> Column:
    """The mapped value, or the value itself."""
    if not values:
        return c
    known = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return F.coalesce(F.try_element_at(known, c), c)


def flag(c: Column, active: list[str], inactive: list[str], exact: bool = False) -> Column:
    """1 for active words, -1 for inactive ones, else 0; unless exact, case and outer blanks don't count."""
    word = c if exact else F.lower(F.trim(c))
    return F.coalesce(F.when(word.isin(active), 1).when(word.isin(inactive), -1), F.lit(0))


def without_prefix(c: Column, prefix: str) -> Column:
    return F.regexp_replace(c, "^" + prefix, "")


def encode_key(*parts: Column) -> Column:
    """Parts joined by |, null as empty."""
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def decode_key(c: Column, names: list[str]) -> list[Column]:
    parts = F.split(c, r"[|]")
    return [F.nullif(F.get(parts, i), F.lit("")).alias(n) for i, n in enumerate(names)]


def without_last_token(c: Column) -> Column:
    return F.regexp_replace(c, "_[^_]*$", "")


def first_tokens(c: Column, n: int) -> Column:
    return F.substring_index(c, "_", n)


def species_code(c: Column) -> Column:
    """First letter of the genus and the species, in lower case."""
    parts = F.split(F.trim(c), " ")
    return F.lower(F.concat(F.substring(F.get(parts, 0), 1, 1), F.get(parts, 1)))


def sentinel(c: Column, missing: str = "<NA>") -> Column:
    return F.coalesce(F.trim(c), F.lit(missing))


def family(activity_type: Column, unit: Column, bucket: Column) -> Column:
    """Coarse endpoint family of a bucket (DR: dose response, SP: single point)."""
    return (
        F.when((bucket == "DR") & F.upper(activity_type).startswith("MIC"), "DR_growth_MIC").when(bucket == "DR", "DR_other_potency")
        .when(unit.eqNullSafe(F.lit("mm")), "SP_zone").otherwise("SP_percent")
    )


def target_class(target_type: Column, curated: Column) -> Column:
    """SINGLE PROTEIN, ORGANISM or DISCARDED."""
    raw, cur = F.upper(F.trim(target_type)), F.upper(F.trim(curated))
    return (
        F.when(curated.isNull(), "DISCARDED")
        .when((raw == "UNCHECKED") & cur.isin("ORGANISM", "SINGLE PROTEIN"), cur)
        .when((raw == "NON-MOLECULAR") & (cur == "ORGANISM"), cur)
        .when(raw.isin("SINGLE PROTEIN", "PROTEIN COMPLEX", "PROTEIN FAMILY"), "SINGLE PROTEIN")
        .when(raw == "ORGANISM", "ORGANISM").otherwise("DISCARDED")
    )


def triage(target_type: Column, target_id: Column, bao_label: Column, organism: Column, entity: str, unknown_target: str,
           protein_types: list[str], discarded_types: list[str], ambiguous_types: list[str], subcellular: str = "SUBCELLULAR") -> Column:
    """text_only where the target is known from its type, else full_inference."""
    kind = F.trim(F.coalesce(target_type, F.lit("")))
    named = F.coalesce(F.trim(target_id) != unknown_target, F.lit(True))
    here = F.contains(F.lower(F.coalesce(organism, F.lit(""))), F.lit(entity.lower()))
    based = F.contains(F.lower(F.coalesce(bao_label, F.lit(""))), F.lit("organism-based"))
    known = (kind.isin(*protein_types, subcellular) & named) | kind.isin(discarded_types) | ((kind == "ORGANISM") & here) | (kind.isin(ambiguous_types) & based & here)
    return F.when(known, "text_only").otherwise("full_inference")


def prefill(target_type: Column, target_id: Column, target_name: Column, organism: Column, entity: str, entity_id: str,
            protein_types: list[str], discarded_types: list[str], subcellular: str = "SUBCELLULAR") -> Column:
    """A struct of curated type, id, name and organism for targets known from their type."""
    kind, text = F.trim(F.coalesce(target_type, F.lit(""))), lambda c: F.coalesce(c, F.lit(""))

    def fields(a: Column, b: Column, c: Column) -> Column:
        return F.struct(a.alias("target_type_curated"), b.alias("target_id_curated"), c.alias("target_name_curated"), text(organism).alias("assay_organism_curated"))

    own = fields(kind, text(target_id), text(target_name))
    return (
        F.when(kind.isin(*protein_types, subcellular), own).when(kind.isin(discarded_types), fields(F.lit("DISCARDED"), F.lit(""), F.lit("")))
        .otherwise(fields(F.lit("ORGANISM"), F.lit(entity_id), F.lit(entity)))
    )


def first_category(c: Column, patterns: list[tuple[str, str]], other: str = "other") -> Column:
    """The name of the first pattern that the text holds."""
    out = F
    for name, pattern in patterns:
        out = out.when(c.rlike(pattern), name)
    return out.otherwise(other)


def reason_group(c: Column) -> Column:
    """Failure reasons in seven groups."""
    return (
        F.when(c == "successfully_merged", "Merged OK").when(c == "insufficient_fractional_contribution", "Frac. contribution < 5%")
        .when(c.startswith("insufficient_compounds"), "Too few compounds")
        .when(c.isin("insufficient_compatible_assays", "group_qualified_pass1", "group_qualified_pass2"), "No group partner")
        .when(c.startswith("insufficient_positives"), "Too few positives")
        .when(c.isin("excluded_pubchem_assay", "excluded_no_target_chembl_id", "no_expert_cutoff"), "Excluded / no cutoff").otherwise("Other")
    )


def dataset_name(assay: Column, activity: Column, kind: Column, cutoff: Column) -> Column:
    """assay_activity_qt_cutoff, assay_activity_ql or assay_activity_mx_cutoff."""
    tag = F.when(kind == "quantitative", "qt").when(kind == "qualitative", "ql").otherwise("mx")
    return F.concat_ws("_", assay.cast("string"), activity, tag, F.when(kind != "qualitative", cutoff.cast("string")))


def context(**parts: Column) -> Column:
    """Lines `name: value` of the values that are there; long ones end in '...' after 1000 characters."""
    lines = (F.when(c.isNotNull(), F.concat(F.lit(f"{n}: "), F.when(F.length(c.cast("string")) > 1000, F.concat(F.substring(c.cast("string"), 1, 1000), F.lit("..."))).otherwise(c.cast("string")))) for n, c in parts.items())
    return F.concat_ws("\n", *lines)


#: Cells that mean true or false.
TRUE, FALSE = ["true", "t", "yes", "y", "1"], ["false", "f", "no", "n", "0"]


def truth(c: Column) -> Column:
    """True or false of a cell's text, whatever its case and blanks; null for anything else."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(TRUE), True).when(word.isin(FALSE), False)


#: What a class of organisms is called, and what is measured on it.
ORGANISM_CLASSES = {"fungus": "antifungal activity, growth inhibition", "parasite": "antiparasitic activity, growth inhibition", "bacteria": "antibacterial activity, growth inhibition, MIC determination"}


def class_template(organism: Column, organism_id: Column, organism_class: Column, targets: Column) -> Column:
    """A paragraph on an organism: its id, its class with what is measured on it, and its known targets (array of id, name, synonyms)."""
    kinds = F.create_map(*(F.lit(x) for pair in ORGANISM_CLASSES.items() for x in pair))
    known = F.coalesce(F.try_element_at(kinds, organism_class), F.lit(ORGANISM_CLASSES["bacteria"]))
    lines = F.transform(targets, lambda t: F.concat(F.lit("- "), t["id"], F.lit(": "), t["name"], F.when(F.size(t["synonyms"]) > 0, F.concat(F.lit(" (also "), F.array_join(t["synonyms"], ", "), F.lit(")"))).otherwise("")))
    first = F.format_string("%s (%s), id %s. Measured: %s.", organism, F.coalesce(organism_class, F.lit("bacteria")), F.coalesce(organism_id, F.lit("UNKNOWN")), known)
    return F.concat_ws("\n", first, F.when(F.size(targets) > 0, F.array_join(lines, "\n")))
