from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quantarium.functions import structures


@pytest.fixture(scope="module")
def told(spark):
    def tell(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", structures.read(F.col("t")).alias("m"))
        df = df.select("*", structures.parent(F.col("m")).alias("p"), structures.fingerprint(F.col("m")).alias("f"))
        rows = df.select("i", "m", "f", structures.key(F.col("m")).alias("key"), structures.key(F.col("p")).alias("parent"), structures.weight(F.col("m")).alias("w"), structures.dense(F.col("f")).alias("d")).collect()
        return [r for r in sorted(rows, key=lambda r: r["i"])]

    return tell


SAME = [
    ["CCO", "OCC", "C(O)C", "[CH3][CH2][OH]", "[H]OC([H])([H])C([H])([H])[H]", "C-C-O"],
    ["c1ccccc1C(=O)O", "OC(=O)c1ccccc1", "O=C(O)c9ccccc9", "c1ccc(cc1)C(O)=O", "c%11ccccc%11C(=O)O"],
    ["c1ccccc1-c1ccccc1", "c1ccc(cc1)c2ccccc2"],
    ["Cn1cnc2c1c(=O)n(C)c(=O)n2C"],
    ["C1CC1.CC", "CC.C1CC1"],
    ["C1.C1", "CC"],
    ["C12C3C4C1C5C2C3C45"],
    ["N[C@@H](C)C(=O)O", "OC(=O)C(C)N"],
    ["F/C=C/F", "FC=CF"],
]
#: Same numbers of atoms of each kind, and the second pair also the same colours without marks.
APART = [["CCCO", "CC(C)O", "CCOC"], ["C1CCC2CCCCC2C1", "C1CCC(C1)C1CCCC1"], ["C1CCCCC1.C1CC1", "C1CCCC1.C1CCC1"], ["C=CO", "CC=O"], ["[13CH4]", "C"], ["c1ccncc1C", "Cc1ccccn1", "Cc1ccncc1"]]


def test_spellings_share_a_key_and_structures_do_not(told):
    texts = [t for group in SAME for t in group]
    got = dict(zip(texts, told(texts)))
    keys = [{got[t]["key"] for t in group} for group in SAME]
    assert all(len(k) == 1 and None not in k for k in keys) and len(set.union(*keys)) == len(SAME)
    assert all(len({tuple(got[t]["f"]) for t in group}) == 1 for group in SAME)
    apart = dict(zip([t for group in APART for t in group], told([t for group in APART for t in group])))
    for group in APART:
        assert len({apart[t]["key"] for t in group}) == len(group)


def test_random_spellings(told):
    """A structure written from any of its atoms, with neighbours in any order."""
    graphs = {
        "phenol": ("ccccccO", [(0, 1, ""), (1, 2, ""), (2, 3, ""), (3, 4, ""), (4, 5, ""), (5, 0, ""), (5, 6, "")]),
        "cubane": ("C" * 8, [(0, 1, ""), (1, 2, ""), (2, 3, ""), (3, 0, ""), (4, 5, ""), (5, 6, ""), (6, 7, ""), (7, 4, ""), (0, 4, ""), (1, 5, ""), (2, 6, ""), (3, 7, "")]),
        "adamantane": ("C" * 10, [(0, 4, ""), (0, 5, ""), (0, 6, ""), (1, 4, ""), (1, 7, ""), (1, 8, ""), (2, 5, ""), (2, 7, ""), (2, 9, ""), (3, 6, ""), (3, 8, ""), (3, 9, "")]),
        "chain": ("CNCOCSCC", [(0, 1, ""), (1, 2, "="), (2, 3, ""), (2, 4, ""), (4, 5, ""), (5, 6, ""), (4, 7, "#")]),
    }
    r = random.Random(3)

    def spell(atoms, bonds):
        near = {i: [] for i in range(len(atoms))}
        for a, b, mark in bonds:
            near[a].append((b, mark))
            near[b].append((a, mark))
        seen, rings = {}, {}

        def order(i, back):
            seen[i] = True
            kids = []
            for j, mark in r.sample(near[i], len(near[i])):
                if j == back:
                    continue
                if j in seen:
                    if frozenset((i, j)) not in rings:
                        rings[frozenset((i, j))] = (str(len(rings) + 1), mark)
                else:
                    kids.append((j, mark, order(j, i)))
            return kids

        start = r.randrange(len(atoms))
        tree = order(start, None)

        def write(i, kids):
            kids = [k for k in kids if frozenset((i, k[0])) not in rings]
            own = atoms[i] + "".join(mark + n for pair, (n, mark) in rings.items() if i in pair)
            parts = [mark + write(j, below) for j, mark, below in kids]
            return own + "".join(f"({p})" for p in parts[:-1]) + "".join(parts[-1:])

        return write(start, tree)

    texts = [(name, spell(list(atoms), bonds)) for name, (atoms, bonds) in graphs.items() for _ in range(25)]
    keys = {(name, x["key"]) for (name, _), x in zip(texts, told([t for _, t in texts]))}
    assert len(set(texts)) > 20 and len(keys) == len({k for _, k in keys}) == len(graphs) and None not in {k for _, k in keys}


def test_weights_and_hydrogens(told):
    want = {"O": 18.015, "C": 16.043, "c1ccccc1": 78.114, "CC(=O)O": 60.052, "CS(=O)(=O)C": 94.128, "[Na+].[Cl-]": 58.44, "Cn1cccc1": 81.118, "c1ccsc1": 84.136, "c1cc[nH]c1": 67.091, "[13CH4]": 17.032, "CP(C)(C)=O": 92.078}
    got = told(list(want))
    assert {t: r["w"] for t, r in zip(want, got)} == pytest.approx(want, abs=0.002)


def test_parents(told):
    same = ["CC(=O)O", "CC(=O)[O-].[Na+]", "[Na+].CC(=O)[O-]", "[K+].[O-]C(C)=O.[Cl-]"]
    assert len({r["parent"] for r in told(same)}) == 1
    assert len({r["parent"] for r in told(["CCN", "CC[NH3+].[Br-]", "Cl.NCC"])}) == 1
    nitro, isomers, ties = told(["C[N+](=O)[O-]", "CCO.COC", "COC.CCO"])
    assert nitro["parent"] == nitro["key"] and isomers["parent"] == ties["parent"]


def test_fingerprints_count(told):
    ethane, long, decane = told(["CC", "C" * 300, "C" * 10])
    assert sum(p["n"] for p in ethane["f"]) == 8 and sum(p["n"] for p in decane["f"]) == 40
    assert max(p["n"] for p in long["f"]) == 127
    for r in (ethane, long, decane):
        assert len(r["d"]) == 2048 and {i: n for i, n in enumerate(r["d"]) if n} == {p["bit"]: p["n"] for p in r["f"]}


def test_unreadable(told):
    bad = [None, "", "  ", "C1CC", "C(C", "CC)", "C=", "=C", "C==C", "(C)", "C..", "[Xx]", "[C", "C1C1", "C11", "Q", "C(=)C", "C C", "1CC1", "*"]
    got = {t: (r["m"], r["key"], r["parent"], r["w"], r["f"], r["d"]) for t, r in zip(bad, told(bad)) if t != "C.."}
    assert set(got.values()) == {(None,) * 6}, {t for t, v in got.items() if v[0]}


def test_similarity_and_rows(spark):
    df = spark.createDataFrame([("CCO", "CCN", 1)], "a string, b string, `x.y` int").withColumn("m", structures.read(F.col("a")))
    prints = df.withColumn("n", structures.read(F.col("b"))).select(structures.fingerprint(F.col("m")).alias("f"), structures.fingerprint(F.col("n")).alias("g"))
    same, other = prints.select(structures.similarity(F.col("f"), F.col("f")), structures.similarity(F.col("f"), F.col("g"))).first()
    assert same == 1.0 and 0 < other < 1
    assert [tuple(r) for r in structures.atom_rows(df, "m", ["x.y"]).collect()] == [(1, 0, "C", False, 0, 0, 3), (1, 1, "C", False, 0, 0, 2), (1, 2, "O", False, 0, 0, 1)]
    assert [tuple(r) for r in structures.bond_rows(df, "m", ["x.y"]).collect()] == [(1, 0, 1, 1), (1, 1, 2, 1)]
