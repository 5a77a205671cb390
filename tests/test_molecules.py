"""Molecules against all pairs."""

import random

from strandweave.operators.molecules import molecule_complexity, molecules
from test_optical import groups

PAIRS = "left_seq string, right_seq string"


def test_molecules_against_all_pairs(spark):
    r = random.Random(6)
    true = [["".join(r.choice("ACGT") for _ in range(n)) for n in (12, 15)] for _ in range(12)]
    rows = []
    for _ in range(500):
        text = [list(x) for x in r.choice(true)]
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            side = r.randrange(2)
            text[side][r.randrange(len(text[side]))] = r.choice("ACGTN")
        rows.append(tuple("".join(x) for x in text))
    rows += [("AAAA", "CCCC"), ("AAAA", "CCC"), ("AAAAA", "CCCC"), ("", "CC"), ("A", "CC"), ("", ""), ("", ""), ("C", "CC"), (None, "A"), ("A", None)]
    known = sorted({x for x in rows if None not in x})

    def one(a, b):
        return all(len(x) == len(y) for x, y in zip(a, b)) and sum(x != y for s, t in zip(a, b) for x, y in zip(s, t)) == 1
    want = {}
    for n, c in groups(known, [(a, b) for a in known for b in known if a < b and one(a, b)]).items():
        want.setdefault(c, set()).add((n, rows.count(n)))
    got = {}
    for x in molecules(spark.createDataFrame(rows, PAIRS)).collect():
        got.setdefault(x.molecule, set()).add(((x.left_seq, x.right_seq), x.n))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert max(map(len, want.values())) > 10 and {(("A", "CC"), 1), (("C", "CC"), 1)} in want.values()


def test_one_error_stays_one_molecule(spark):
    text = "ACGTACGTAC" * 3
    rows = [(text, text)] * 5 + [(text, text[:k] + "N" + text[k + 1:]) for k in range(30)] + [(text[:k] + "N" + text[k + 1:], text) for k in range(30)]
    assert [(x.set_size, x.sets) for x in molecule_complexity(spark.createDataFrame(rows, PAIRS)).collect()] == [(65, 1)]
    assert molecule_complexity(spark.createDataFrame([], PAIRS)).count() == 0
