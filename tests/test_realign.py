"""Local realignment on a planted contig: long and complex alleles, clips, reads over several blocks."""

import random

import pytest

from strandweave.operators import realign
from strandweave.operators.reference import reference_blocks

READS = "read_name string, mate int, flag int, contig_idx int, contig string, pos int, cigar string, seq string, quals array<int>"
KNOWN = "contig_idx int, contig string, pos int, id string, ref string, alt string"
SPOT = 12_000  # the base before the allele


@pytest.fixture(scope="module")
def contig():
    r = random.Random(8)
    return "".join(r.choice("ACGT") for _ in range(25_000))


def moved(spark, contig, gone, ins, reads):
    """{name: (pos, cigar)} after realignment of reads (name, head, n, lead, trail, keep_end) of the changed contig."""
    hap = contig[:SPOT] + ins + contig[SPOT + gone:]
    rows = []
    for name, head, n, lead, trail, keep_end in reads:
        seq = hap[SPOT - head:SPOT - head + n]
        pos = SPOT - head + 1 + (gone - len(ins) if keep_end else 0)
        core = n - lead - trail
        cigar = (f"{lead}S" if lead else "") + f"{core}M" + (f"{trail}S" if trail else "")
        rows.append((name, 1, 0, 0, "c", pos + lead, cigar, seq, [30] * n))
    df = spark.createDataFrame(rows, READS)
    ref, alt = contig[SPOT - 1:SPOT + gone], contig[SPOT - 1] + ins
    known = spark.createDataFrame([(0, "c", SPOT, ".", ref, alt)], KNOWN)
    blocks = reference_blocks(spark.createDataFrame([(0, "c", contig)], "contig_idx int, contig string, seq string"))
    targets = realign.realign_targets(df, known)
    out = realign.realign_indels(df, targets, blocks, known)
    assert out.columns == df.columns and out.count() == len(rows)
    return {r["read_name"]: (r["pos"], r["cigar"]) for r in out.collect()}


@pytest.mark.parametrize("gone,ins", [(30, ""), (70, ""), (1500, ""), (0, "GATTACAGATTACAGATTACA" * 3), (70, "TTGCA")])
def test_alleles_of_any_length(spark, contig, gone, ins):
    n = 150
    # most of the read lies on the side that is kept in place
    if gone and ins:  # an end that the reference has in the same place would be trimmed
        ins = ins[:-1] + next(c for c in "ACGT" if c != contig[SPOT + gone - 1])
    reads = [(f"s{k}", n - len(ins) - 20 - k, n, 0, 0, False) for k in range(6)] + [(f"e{k}", 20 + k, n, 0, 0, True) for k in range(6)]
    got = moved(spark, contig, gone, ins, reads)
    middle = (f"{gone}D" if gone else "") + (f"{len(ins)}I" if ins else "")
    for name, head, *_ in reads:
        pos, cigar = got[name]
        tail = n - head - len(ins)
        # equivalent placements of the same allele may start a few bases beside
        assert pos == SPOT - head + 1 and cigar == f"{head}M{middle}{tail}M", (name, pos, cigar)


def test_clips_stay_at_the_ends(spark, contig):
    got = moved(spark, contig, 30, "", [("a", 60, 100, 0, 10, False), ("b", 60, 100, 8, 0, False), ("c", 60, 100, 5, 10, False), ("d", 30, 100, 10, 0, True)])
    assert got["a"] == (SPOT - 59, "60M30D30M10S")
    assert got["b"] == (SPOT - 51, "8S52M30D40M")
    assert got["c"] == (SPOT - 54, "5S55M30D30M10S")
    assert got["d"] == (SPOT - 19, "10S20M30D70M")


def test_a_read_over_several_blocks(spark, contig):
    got = moved(spark, contig, 45, "", [("long", 2600, 6000, 0, 0, False), ("longer", 11_000, 12_000, 0, 0, False)])
    assert got["long"] == (SPOT - 2599, "2600M45D3400M") and got["longer"] == (SPOT - 10_999, "11000M45D1000M")


def test_nothing_to_move(spark, contig):
    df = spark.createDataFrame([("x", 1, 4, 0, "c", 1, "*", "ACGT", [30] * 4)], READS)
    blocks = reference_blocks(spark.createDataFrame([(0, "c", contig)], "contig_idx int, contig string, seq string"))
    targets = realign.realign_targets(df, None)
    assert realign.realign_indels(df, targets, blocks, None).count() == 1
