"""Patterns, clusters of mismatches and allele counts against brute force."""

import itertools
import math
import random

import pytest

from strandweave.functions.bases import copy_terms
from strandweave.operators import realign, sites
from strandweave.operators.reference import find_patterns, reference_blocks

CONTIG = "contig_idx int, contig string, seq string"


def test_patterns_of_any_length(spark):
    r = random.Random(3)
    seqs = ["".join(r.choice("ACGT") for _ in range(23_000)), "ACG" * 300, "A" * 40, "C"]
    seqs.append(seqs[0][9_000:12_500])
    patterns = [seqs[0][a:a + n] for a, n in ((0, 12), (9_990, 30), (9_500, 3_000), (10_999, 2), (22_990, 10), (19_999, 1_500))]
    patterns += ["A", "AC", "ACGACG", "ACGACGACGACGACG", "A" * 12, "A" * 40, "A" * 41, "GATTACAGATTACAGATTACA", "", None, seqs[0][5:40], seqs[0][5:40]]
    blocks = reference_blocks(spark.createDataFrame([(c, f"c{c}", s) for c, s in enumerate(seqs)], CONTIG))
    got = sorted(map(tuple, find_patterns(blocks, spark.createDataFrame(list(enumerate(patterns)), "pattern_id int, pattern string")).collect()))
    want = sorted((i, c, f"c{c}", k + 1) for i, p in enumerate(patterns) if p for c, s in enumerate(seqs) for k in range(len(s)) if s.startswith(p, k))
    assert got == want
    assert find_patterns(blocks, spark.createDataFrame([], "pattern_id int, pattern string")).count() == 0


def enumerated(bases, theta):
    """(qual, ac, an) from (sample, letter, quality) rows of one site with reference A and alternate C."""
    t = copy_terms(2)
    by = {}
    for s, b, q in bases:
        row = by.setdefault(s, [0, 0, 0])
        for k in range(3):
            row[k] += t[k if b == "A" else 2 - k][q]
    n, z = len(by), {}
    for genotypes in itertools.product(range(3), repeat=n):
        weight = math.prod(10 ** (row[g] / 1e6) * (2 if g == 1 else 1) for g, row in zip(genotypes, by.values()))
        z[sum(genotypes)] = z.get(sum(genotypes), 0) + weight
    prior = [1 - sum(theta / k for k in range(1, 2 * n + 1))] + [theta / k for k in range(1, 2 * n + 1)]
    post = [z[k] / math.comb(2 * n, k) * prior[k] for k in range(2 * n + 1)]
    return round(10 * math.log10(sum(post) / post[0]), 2), max(range(2 * n + 1), key=post.__getitem__), 2 * n


@pytest.mark.parametrize("samples", [1, 2, 4, 6])
def test_joint_calls_against_enumeration(spark, samples):
    r, rows, per = random.Random(samples), [], {}
    for pos in range(1, 40):
        for s in range(samples):
            copies = r.choice([0, 0, 1, 2])
            for _ in range(r.randrange(0, 9)):
                letter, q = ("C" if r.random() < copies / 2 else "A"), r.randrange(11, 40)
                rows.append((0, "c", pos, "A", letter, q, None if s == 0 else f"s{s}"))
                per.setdefault(pos, []).append((s, letter, q))
    pile = spark.createDataFrame(rows, "contig_idx int, contig string, pos int, ref_base string, base string, q int, sample string")
    got = {x.pos: (x.qual, x.ac, x.an) for x in sites.call_joint(pile, conf=3).collect()}
    want = {p: enumerated(b, sites.SNP_THETA) for p, b in per.items() if any(x[1] == "C" for x in b)}
    want = {p: w for p, w in want.items() if w[0] >= 3}
    assert got.keys() == want.keys() and len(got) > 8
    for p in got:
        assert got[p][1:] == want[p][1:] and abs(got[p][0] - want[p][0]) < 0.02


def test_clusters_of_mismatches(spark):
    r = random.Random(1)
    seq = "".join(r.choice("ACGT") for _ in range(3000))
    other = {c: "CGTA"["ACGT".index(c)] for c in "ACGT"}
    rows = []
    for i in range(20):
        for at, spots in ((500, (540, 545)), (960, (998, 1004)), (1500, (1530,)), (2000, (2010, 2035))):
            text = [other[c] if at + k in spots and i % 2 else c for k, c in enumerate(seq[at - 1:at + 99], 0) for c in [c]]
            rows.append((f"r{at}_{i}", 1, 0, 0, "c", at, "100M", "".join(text), [30] * 100))
    df = spark.createDataFrame(rows, "read_name string, mate int, flag int, contig_idx int, contig string, pos int, cigar string, seq string, quals array<int>")
    blocks = reference_blocks(spark.createDataFrame([(0, "c", seq)], CONTIG))
    got = sorted((x.start, x.end) for x in realign.mismatch_clusters(df, blocks).collect())
    assert got == [(540, 545), (998, 1004)]  # one locus, or two that are far apart, are none
    assert [(x.start, x.end) for x in realign.realign_targets(df, None, blocks=blocks).orderBy("start").collect()] == [(530, 555), (988, 1014)]


def test_mates_are_found_by_their_partners(spark):
    from strandweave.operators import rescue
    r = random.Random(12)
    seqs = ["".join(r.choice("ACGT") for _ in range(11_500)) for _ in range(2)]
    turn = lambda s: s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))
    reads, hits, want = [], [], {}
    for k in range(60):
        c, start, size, n, m = k % 2, r.choice([1, 60, 9_900, 11_200, r.randrange(1, 11_200)]), r.randrange(180, 221), 60, r.choice([45, 70])
        left, right = seqs[c][start - 1:start - 1 + n], seqs[c][start - 1 + size - m:start - 1 + size]
        wrong = list(right)
        for at in range(7, m, 15):
            wrong[at] = "CGTAN"["ACGT".index(wrong[at])] if k % 5 else "N"
        wrong = "".join(wrong)
        first, second = (left, turn(wrong)) if k % 3 else (turn(wrong), left)
        mate = 1 if k % 3 else 2  # of the placed read, on the forward strand
        reads += [(f"f{k}", 1, first), (f"f{k}", 2, second)]
        hits.append((f"f{k}", mate, "+", c, start, 0, f"{n}M", 1))
        if len(right) == m:
            want[f"f{k}"] = (3 - mate, "-", c, start + size - m, len(range(7, m, 15)), f"{m}M")
    reads += [("none", 1, seqs[0][:50]), ("none", 2, seqs[0][100:150]), ("null", 1, None)]
    df = spark.createDataFrame(reads, "read_name string, mate int, seq string")
    placed = spark.createDataFrame(hits, "read_name string, mate int, strand string, contig_idx int, pos int, nm int, cigar string, n_loci long")
    blocks = reference_blocks(spark.createDataFrame([(c, "c", s) for c, s in enumerate(seqs)], CONTIG))
    got = {x.read_name: (x.mate, x.strand, x.contig_idx, x.pos, x.nm, x.cigar) for x in rescue.rescue_mates(df, placed, blocks, 200, 25, 5).collect()}
    assert got == want and len(want) > 50
    assert rescue.rescue_mates(df, placed.filter("false"), blocks, 200, 25).count() == 0


def test_site_counts_are_both_annotations(spark):
    from strandweave.operators import annotate
    rows = [(0, p, "*" if (p + k) % 3 == 0 else "A") for p in range(1, 9) for k in range(p)]
    pile = spark.createDataFrame(rows, "contig_idx int, pos int, base string")
    calls = spark.createDataFrame([(0, p) for p in (1, 2, 3, 8, 50)], "contig_idx int, pos int")
    got = annotate.ann_site_counts(calls, pile)
    want = annotate.ann_spanning_deletions(annotate.ann_depth(calls, pile), pile)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert (0, 50, 0, 0.0) in map(tuple, got.collect()) and (0, 3, 3, round(1 / 3, 6)) in map(tuple, got.collect())
