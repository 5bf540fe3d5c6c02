"""Chemical structures as columns: text to atoms and bonds, one key for all spellings, parents, weights, fragments.

All of it is JVM expressions over one row's arrays, so no row moves and no Python runs. A structure
is a struct of `atoms` and `bonds`; places in `atoms` are what bonds refer to. Stereo marks are
read and dropped, and alternating double bonds are not turned into aromatic ones, so the two
spellings of such a ring have two keys. Work grows with the square of a structure's atoms. Give each
function a column of an earlier select (`read` first, then `parent`, then `key`), not another's call:
such nesting is deeper than the analyzer goes.

Defined results: null, empty and unreadable text (an unknown element, an open ring or branch, a
bond without an end) is null, and so is whatever is taken from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard atomic weights.
WEIGHTS = """H 1.008 He 4.003 Li 6.94 Be 9.012 B 10.81 C 12.011 N 14.007 O 15.999 F 18.998 Ne 20.18 Na 22.99 Mg 24.305 Al 26.982 Si 28.085
P 30.974 S 32.06 Cl 35.45 Ar 39.95 K 39.098 Ca 40.078 Sc 44.956 Ti 47.867 V 50.942 Cr 51.996 Mn 54.938 Fe 55.845 Co 58.933 Ni 58.693 Cu 63.546
Zn 65.38 Ga 69.723 Ge 72.63 As 74.922 Se 78.971 Br 79.904 Kr 83.798 Rb 85.468 Sr 87.62 Y 88.906 Zr 91.224 Nb 92.906 Mo 95.95 Ru 101.07 Rh 102.906
Pd 106.42 Ag 107.868 Cd 112.414 In 114.818 Sn 118.71 Sb 121.76 Te 127.6 I 126.904 Xe 131.293 Cs 132.905 Ba 137.327 La 138.905 Gd 157.25 W 183.84
Re 186.207 Os 190.23 Ir 192.217 Pt 195.084 Au 196.967 Hg 200.592 Tl 204.38 Pb 207.2 Bi 208.98"""
# Normal valences of elements that may stand without brackets.
VALENCES = {"B": [3], "C": [4], "N": [3, 5], "O": [2], "P": [3, 5], "S": [2, 4, 6], "F": [1], "Cl": [1], "Br": [1], "I": [1]}

_TOKEN = r"\[[^\[\]]*\]|Br|Cl|[BCNOPSFIbcnops]|%\d\d|\d|[-=#$:/\\~.()]"
_BRACKET = r"^\[(\d*)([A-Z][a-z]?|[a-z]{1,2})@{0,2}(H\d?)?(\+\d+|-\d+|\++|-+)?(?::\d+)?\]$"
AROMATIC = 5
BITS, RADIUS, MOST = 2048, 3, 127

_BONDS = "array<struct<a: int, b: int, kind: int>>"


def _mass(element: Column) -> Column:
    words = WEIGHTS.split()
    return F.expr("map(" + ", ".join(f"'{x}', {float(w)}D" for x, w in zip(words[::2], words[1::2])) + ")")[element]


def _valences(element: Column) -> Column:
    return F.expr("map(" + ", ".join(f"'{x}', array({', '.join(map(str, v))})" for x, v in VALENCES.items()) + ")")[element]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(array: Column) -> Column:
    return F.transform(array, lambda _, i: i)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda s, x: s + x)


def _token(t: Column) -> Column:
    """What a token is, and its atom if it is one."""
    bracket = t.startswith("[")
    symbol = F.when(bracket, F.regexp_extract(t, _BRACKET, 2)).otherwise(t)
    charge, hydrogens = F.regexp_extract(t, _BRACKET, 4), F.regexp_extract(t, _BRACKET, 3)
    digits = F.regexp_extract(charge, r"(\d+)", 1)
    size = F.when(digits != "", digits.try_cast("int")).otherwise(F.length(charge))
    atom = F.struct(
        F.initcap(symbol).alias("element"), (symbol == F.lower(symbol)).alias("aromatic"),
        F.when(bracket, F.when(charge.startswith("-"), -size).otherwise(size)).otherwise(0).alias("charge"),
        F.when(bracket, F.coalesce(F.regexp_extract(t, _BRACKET, 1).try_cast("int"), F.lit(0))).otherwise(0).alias("isotope"),
        F.when(bracket, F.when(hydrogens == "", 0).otherwise(F.coalesce(F.substring(hydrogens, 2, 1).try_cast("int"), F.lit(1)))).alias("hydrogens"),
    )
    kind = F.when(t.rlike("^[-=#$:/\\\\~]$"), "bond").when(t == "(", "open").when(t == ")", "close").when(t == ".", "dot").when(t.rlike(r"^%?\d+$"), "ring").otherwise("atom")
    return F.struct(kind.alias("kind"), F.ltrim(t, F.lit("%")).alias("text"), atom.alias("atom"))


def _walk(tokens: Column) -> Column:
    """The bonds as written (a, b, mark), and whether the text ends whole."""
    nothing = F.struct(
        F.lit(0).alias("n"), F.lit(-1).alias("at"), F.lit("").alias("mark"), F.lit(False).alias("bad"), F.array().cast("array<int>").alias("stack"),
        F.array().cast("array<struct<label: string, atom: int, mark: string>>").alias("rings"), F.array().cast("array<struct<a: int, b: int, mark: string>>").alias("bonds"),
    )

    def step(s: Column, t: Column) -> Column:
        is_ = {k: t["kind"] == k for k in ("atom", "bond", "ring", "open", "close", "dot")}
        opened = F.get(F.filter(s["rings"], lambda r: r["label"] == t["text"]), F.lit(0))
        none, deep = s["at"] < 0, F.size(s["stack"])
        bond = F.when(is_["atom"] & ~none, F.struct(s["at"].alias("a"), s["n"].alias("b"), s["mark"].alias("mark"))).when(
            is_["ring"] & opened.isNotNull(), F.struct(opened["atom"].alias("a"), s["at"].alias("b"), F.when(s["mark"] != "", s["mark"]).otherwise(opened["mark"]).alias("mark"))
        )
        marked = s["mark"] != ""
        bad = F.when(is_["atom"], none & marked).when(is_["ring"], none | F.coalesce(opened["atom"] == s["at"], F.lit(False))).when(is_["open"], none | marked)
        bad = bad.when(is_["close"], (deep == 0) | marked).when(is_["dot"], (deep > 0) | marked).otherwise(marked)
        ring = F.struct(t["text"].alias("label"), s["at"].alias("atom"), s["mark"].alias("mark"))
        return F.struct(
            F.when(is_["atom"], s["n"] + 1).otherwise(s["n"]).alias("n"),
            F.when(is_["atom"], s["n"]).when(is_["close"], F.coalesce(F.get(s["stack"], deep - 1), F.lit(-1))).when(is_["dot"], -1).otherwise(s["at"]).alias("at"),
            F.when(is_["bond"], t["text"]).when(is_["atom"] | is_["ring"], "").otherwise(s["mark"]).alias("mark"),
            (s["bad"] | bad).alias("bad"),
            F.when(is_["open"], F.concat(s["stack"], F.array(s["at"]))).when(is_["close"], F.slice(s["stack"], 1, F.greatest(deep - 1, F.lit(0)))).otherwise(s["stack"]).alias("stack"),
            F.when(is_["ring"], F.when(opened.isNull(), F.concat(s["rings"], F.array(ring))).otherwise(F.filter(s["rings"], lambda r: r["label"] != t["text"]))).otherwise(s["rings"]).alias("rings"),
            F.when(bond.isNotNull(), F.concat(s["bonds"], F.array(bond))).otherwise(s["bonds"]).alias("bonds"),
        )

    def end(s: Column) -> Column:
        pairs = F.transform(s["bonds"], lambda b: F.struct(F.least(b["a"], b["b"]), F.greatest(b["a"], b["b"])))
        whole = ~s["bad"] & (s["mark"] == "") & (F.size(s["stack"]) == 0) & (F.size(s["rings"]) == 0) & (F.size(F.array_distinct(pairs)) == F.size(pairs))
        return F.when(whole, s["bonds"])

    return F.aggregate(tokens, nothing, step, end)


def _neighbours(m: Column) -> Column:
    """Of each atom, its bonds as (kind, to)."""

    def of(_: Column, i: Column) -> Column:
        out = F.transform(F.filter(m["bonds"], lambda b: b["a"] == i), lambda b: F.struct(b["kind"].alias("kind"), b["b"].alias("to")))
        back = F.transform(F.filter(m["bonds"], lambda b: b["b"] == i), lambda b: F.struct(b["kind"].alias("kind"), b["a"].alias("to")))
        return F.concat(out, back)

    return F.transform(m["atoms"], of)


def _with_hydrogens(m: Column, near: Column) -> Column:
    """Atoms whose hydrogens are all counted: those without brackets fill up a normal valence."""

    def fill(a: Column, i: Column) -> Column:
        used = _sum(F.transform(F.get(near, i), lambda e: F.when(e["kind"] == AROMATIC, 1).otherwise(e["kind"]))) + a["aromatic"].cast("int")
        normal = _valences(a["element"])
        room = F.when(a["aromatic"], F.get(normal, F.lit(0))).otherwise(F.array_min(F.filter(normal, lambda v: v >= used)))
        return _atom(a, hydrogens=F.coalesce(a["hydrogens"], F.greatest(room - used, F.lit(0)), F.lit(0)))

    return F.transform(m["atoms"], fill)


def _atom(a: Column, **new: Column) -> Column:
    return F.struct(*((new.get(c, a[c])).alias(c) for c in ("element", "aromatic", "charge", "isotope", "hydrogens")))


def _part(m: Column, keep: Column) -> Column:
    """The structure of the atoms that are kept and the bonds among them; m and keep are bound already."""
    number = F.transform(keep, lambda k, i: F.when(k, F.size(F.filter(F.slice(keep, 1, i), lambda x: x))))

    def cut(number: Column) -> Column:
        bonds = F.transform(m["bonds"], lambda b: F.struct(F.get(number, b["a"]).alias("a"), F.get(number, b["b"]).alias("b"), b["kind"].alias("kind")))
        atoms = F.filter(m["atoms"], lambda _, i: F.get(keep, i))
        return F.struct(atoms.alias("atoms"), F.filter(bonds, lambda b: b["a"].isNotNull() & b["b"].isNotNull()).alias("bonds"))

    return _let(number, cut)


def _folded(m: Column, near: Column) -> Column:
    """Plain hydrogen atoms with one bond become counts of the atoms that they are bound to."""
    plain = lambda a, i: (a["element"] == "H") & (a["charge"] == 0) & (a["isotope"] == 0) & (F.size(F.get(near, i)) == 1) & (F.get(m["atoms"], F.get(F.get(near, i), F.lit(0))["to"])["element"] != "H")
    stays = F.transform(m["atoms"], lambda a, i: ~F.coalesce(plain(a, i), F.lit(False)))

    def fold(stays: Column) -> Column:
        more = lambda i: F.size(F.filter(F.get(near, i), lambda e: ~F.get(stays, e["to"])))
        atoms = F.transform(m["atoms"], lambda a, i: _atom(a, hydrogens=a["hydrogens"] + more(i)))
        counted = _let(F.struct(atoms.alias("atoms"), m["bonds"].alias("bonds")), lambda c: _part(c, stays))
        return F.when(F.forall(stays, lambda x: x), m).otherwise(counted)

    return _let(stays, fold)


def read(text: Column) -> Column:
    """The structure of a line notation (SMILES); null where it can't be read."""
    kind = {"=": 2, "#": 3, "$": 4}

    def build(x: Column) -> Column:
        def join(x: Column) -> Column:
            def typed(b: Column) -> Column:
                rings = F.get(x["atoms"], b["a"])["aromatic"] & F.get(x["atoms"], b["b"])["aromatic"]
                out = F.when(b["mark"] == ":", AROMATIC)
                for mark, order in kind.items():
                    out = out.when(b["mark"] == mark, order)
                return F.struct(b["a"].alias("a"), b["b"].alias("b"), out.when(rings, AROMATIC).otherwise(1).alias("kind"))

            typed_bonds = F.transform(x["bonds"], typed).cast(_BONDS)
            return F.struct(x["atoms"].alias("atoms"), typed_bonds.alias("bonds"))

        known = ~F.exists(x["atoms"], lambda a: _mass(a["element"]).isNull())
        filled = _let(join(x), lambda m: _let(_neighbours(m), lambda near: _let(F.struct(_with_hydrogens(m, near).alias("atoms"), m["bonds"].alias("bonds")), lambda f: _folded(f, near))))
        return F.when((F.size(x["atoms"]) > 0) & known & x["bonds"].isNotNull(), filled)

    def parse(tokens: Column) -> Column:
        atoms = F.transform(F.filter(tokens, lambda t: t["kind"] == "atom"), lambda t: t["atom"])
        return _let(F.struct(atoms.alias("atoms"), _walk(tokens).alias("bonds")), build)

    def cut(tokens: Column) -> Column:
        whole = (F.size(tokens) > 0) & (F.length(F.array_join(tokens, "")) == F.length(F.trim(text)))
        return F.when(whole, _let(F.transform(tokens, _token), parse))

    return _let(F.regexp_extract_all(F.trim(text), F.lit(f"({_TOKEN})"), F.lit(1)), cut)


def _first_colours(m: Column, near: Column) -> Column:
    return F.transform(m["atoms"], lambda a, i: F.xxhash64(a["element"], a["aromatic"], a["charge"], a["isotope"], a["hydrogens"], F.size(F.get(near, i))))


def _refined(colours: Column, near: Column) -> Column:
    """Each atom's colour with those around it."""
    return F.transform(colours, lambda c, i: F.xxhash64(c, F.array_sort(F.transform(F.get(near, i), lambda e: F.xxhash64(e["kind"], F.get(colours, e["to"]))))))


def _ranking(m: Column, near: Column) -> Column:
    """Colours that tell all atoms apart, the same for every spelling.

    Rounds of refinement; where a round splits nothing more, one atom of the least shared colour is
    marked. Atoms that still share a colour then are taken to be images of each other.
    """
    n = F.size(m["atoms"])

    def step(s: Column, _: Column) -> Column:
        def split(colours: Column) -> Column:
            shared = lambda o: F.array_min(F.filter(o, lambda c, i: c == F.get(o, i + 1)))
            at = F.array_position(s["colours"], _let(F.array_sort(s["colours"]), shared)) - 1
            marked = _let(at, lambda j: F.transform(s["colours"], lambda c, i: F.when(i == j, F.xxhash64(c, F.lit("first"))).otherwise(c)))
            classes = F.size(F.array_distinct(colours))
            more = classes > s["classes"]
            return F.struct(F.when(more, colours).otherwise(marked).alias("colours"), F.when(more, classes).otherwise(s["classes"] + 1).alias("classes"))

        return F.when(s["classes"] == n, s).otherwise(_let(_refined(s["colours"], near), split))

    first = _let(_first_colours(m, near), lambda c: F.struct(c.alias("colours"), F.size(F.array_distinct(c)).alias("classes")))
    return F.aggregate(F.sequence(F.lit(1), 2 * n), first, step, lambda s: s["colours"])


def key(structure: Column) -> Column:
    """One text for all spellings of a structure.

    It hashes the whole list of atoms and bonds in ranked order, so different structures never share
    a key (but for a collision of 256 bits).
    """

    def write(m: Column, colours: Column) -> Column:
        def listed(order: Column) -> Column:
            rank = lambda i: F.array_position(order, F.get(colours, i))
            told = lambda c: F.get(m["atoms"], (F.array_position(colours, c) - 1).cast("int"))
            atoms = F.transform(order, lambda c: F.to_json(told(c)))
            bonds = F.array_sort(F.transform(m["bonds"], lambda b: _let(F.array(rank(b["a"]), rank(b["b"])), lambda p: F.concat_ws("-", F.array_min(p), F.array_max(p), b["kind"]))))
            return F.sha2(F.concat(F.array_join(atoms, ","), F.lit("|"), F.array_join(bonds, ",")), 256)

        return _let(F.array_sort(colours), listed)

    return F.when(structure.isNotNull(), _let(structure, lambda m: _let(_neighbours(m), lambda near: _let(_ranking(m, near), lambda c: write(m, c)))))


def weight(structure: Column) -> Column:
    """Weight with all hydrogens; an isotope weighs its number."""
    of = lambda a: F.when(a["isotope"] > 0, a["isotope"].cast("double")).otherwise(_mass(a["element"])) + a["hydrogens"] * F.lit(1.008)
    return F.round(F.aggregate(structure["atoms"], F.lit(0.0), lambda s, a: s + of(a)), 3)


def _neutral(m: Column) -> Column:
    """Charges that hydrogens can take or give are gone, but for those next to an opposite charge."""

    def balance(near: Column) -> Column:
        def of(a: Column, i: Column) -> Column:
            against = F.exists(F.get(near, i), lambda e: F.get(m["atoms"], e["to"])["charge"] * a["charge"] < 0)
            taken = F.when(a["charge"] > 0, F.least(a["charge"], a["hydrogens"])).otherwise(a["charge"])
            movable = ~against & a["element"].isin("C", "N", "O", "P", "S")
            return F.when(movable, _atom(a, charge=a["charge"] - taken, hydrogens=a["hydrogens"] - taken)).otherwise(_atom(a))

        return F.struct(F.transform(m["atoms"], of).alias("atoms"), m["bonds"].alias("bonds"))

    return _let(_neighbours(m), balance)


def parent(structure: Column) -> Column:
    """The largest fragment, without its salts and their charges; ties go to the heavier, then by key."""

    def fragments(m: Column) -> Column:
        def joined(group: Column, b: Column) -> Column:
            return _let(F.array(F.get(group, b["a"]), F.get(group, b["b"])), lambda p: F.transform(group, lambda g: F.when(g == F.array_max(p), F.array_min(p)).otherwise(g)))

        def largest(group: Column) -> Column:
            one = lambda g: _let(_let(F.transform(group, lambda x: x == g), lambda keep: _part(m, keep)), _neutral)
            parts = F.transform(F.array_distinct(group), one)
            ranked = F.transform(parts, lambda p: F.struct(F.size(p["atoms"]).alias("n"), weight(p).alias("w"), key(p).alias("k"), p.alias("part")))
            return F.when(F.size(F.array_distinct(group)) == 1, _neutral(m)).otherwise(F.array_max(ranked)["part"])

        return _let(F.aggregate(m["bonds"], _places(m["atoms"]), joined), largest)

    return F.when(structure.isNotNull(), _let(structure, fragments))


def fingerprint(structure: Column, bits: int = BITS, radius: int = RADIUS, most: int = MOST) -> Column:
    """Places (bit, n), in order, of circular fragments up to a radius, each counted up to `most`."""

    def counted(ids: Column) -> Column:
        n = lambda b: F.least(F.lit(most), F.size(F.filter(ids, lambda x: x == b)))
        return F.transform(F.array_sort(F.array_distinct(ids)), lambda b: F.struct(b.cast("int").alias("bit"), n(b).cast("tinyint").alias("n")))

    def circles(m: Column, near: Column) -> Column:
        def wider(s: Column, _: Column) -> Column:
            return _let(_refined(s["colours"], near), lambda c: F.struct(c.alias("colours"), F.concat(s["all"], c).alias("all")))

        first = _let(_first_colours(m, near), lambda c: F.struct(c.alias("colours"), c.alias("all")))
        rounds = F.filter(F.sequence(F.lit(0), F.lit(radius)), lambda r: r > 0)
        ids = F.aggregate(rounds, first, wider, lambda s: s["all"])
        return _let(F.transform(ids, lambda x: F.pmod(x, F.lit(bits))), counted)

    return F.when(structure.isNotNull(), _let(structure, lambda m: _let(_neighbours(m), lambda near: circles(m, near))))


def dense(places: Column, bits: int = BITS) -> Column:
    """A fingerprint as an array with its zeros."""
    zeros = lambda n: F.array_repeat(F.lit(0).cast("tinyint"), n)
    before = lambda p, i: F.coalesce(F.get(p, i - 1)["bit"], F.lit(-1))
    filled = F.flatten(F.transform(places, lambda x, i: F.concat(zeros(x["bit"] - before(places, i) - 1), F.array(x["n"]))))
    return F.when(places.isNotNull(), _let(filled, lambda f: F.concat(f, zeros(F.lit(bits) - F.size(f)))))


def similarity(a: Column, b: Column) -> Column:
    """Tanimoto of two fingerprints' counts: shared over all; null where both are empty or one is missing."""
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, p: s + p["n"])
    shared = _let(F.map_from_entries(b), lambda m: F.aggregate(a, F.lit(0), lambda s, p: s + F.least(p["n"].cast("int"), F.coalesce(m[p["bit"]].cast("int"), F.lit(0)))))
    return F.try_divide(shared, total(a) + total(b) - shared)


def dictionary(texts: DataFrame, column: str) -> DataFrame:
    """text, structure, parent, key (of the parent), weight, fingerprint of every distinct text but null.

    A text that many rows share is read once. Rows are small and their work large, so they are dealt
    over all cores by number, which adaptive execution leaves as it is.
    """
    spark = texts.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    each = texts.select(texts[f"`{column}`"].alias("text")).dropna().distinct().repartition(tasks, "text")
    read_ = each.select("text", read(F.col("text")).alias("structure"))
    parents = read_.select("*", parent(F.col("structure")).alias("parent"))
    return parents.select("*", key(F.col("parent")).alias("key"), weight(F.col("parent")).alias("weight"), fingerprint(F.col("parent")).alias("fingerprint"))


def atom_rows(df: DataFrame, structure: str, carry: list[str]) -> DataFrame:
    """A row for each atom: the carried columns, atom (its place) and what it is."""
    return df.select(*(f"`{c}`" for c in carry), F.posexplode(df[f"`{structure}`.atoms"]).alias("atom", "_what")).select(*(f"`{c}`" for c in carry), "atom", "_what.*")


def bond_rows(df: DataFrame, structure: str, carry: list[str]) -> DataFrame:
    """A row for each bond: the carried columns, a, b (places of atoms) and kind (1 to 4, 5 between aromatic atoms)."""
    return df.select(*(f"`{c}`" for c in carry), F.explode(df[f"`{structure}`.bonds"]).alias("_what")).select(*(f"`{c}`" for c in carry), "_what.*")
