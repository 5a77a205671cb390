"""Sums over batches of reads against sums over rows of bases, on reads with odd letters, qualities and operations."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strandweave.functions import arrays
from strandweave.operators import batches, call, pileup, recalibrate
from strandweave.operators.reference import reference_blocks


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("ACGTN" if i % 50 == 0 else "ACGT") for i in range(2500))
    blocks = reference_blocks(spark.createDataFrame([(0, "c", text), (5, "d", text[:300])], "contig_idx int, contig string, seq string"))
    rows = []
    for i in range(300):
        c = rng.choice([0, 0, 5])
        cigar = rng.choice(["50M", "20M3D30M", "10M2I38M", "5S40M5S", "30M", "50M" if c else "1500M", "10M5N40M"])
        n = sum(int(k) for k, op in re.findall(r"(\d+)([MIDNS])", cigar) if op in "MIS")
        seq = "".join(rng.choice("ACGTNa" if rng.random() < 0.1 else "ACGT") for _ in range(n - (i % 37 == 0) * 3))
        quals = [rng.choice([None, 0, 5, 9, 10, 30, 40, 93, 94]) for _ in range(n - (i % 41 == 0) * 2)]
        rows.append((f"r{i % 290}", i % 2 + 1, rng.choice([99, 147, 0, 16, 1024]), c, "cd"[c > 0] if i % 11 else None, rng.randint(1, 240 if c else 2440), cigar,
                     seq if i % 53 else None, quals if i % 59 else None, f"s{i % 3}" if i % 7 else None, (f"rg{i % 3}" if i % 13 else None,)))
    return spark.createDataFrame(rows, "read_name string, mate int, flag int, contig_idx int, contig string, pos int, cigar string, seq string, "
                                 "quals array<int>, sample string, read_group struct<id:string>"), blocks


def listed(df):
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


@pytest.mark.parametrize("quality", [0, 10])
def test_sums_of_reads_are_sums_of_bases(data, quality):
    pile = pileup.pileup(*data, quality, more=("sample",))
    rows = pile.filter("true")
    assert pileup.origin(pile) is not None and pileup.origin(rows) is None
    for more in ({}, {"every_locus": True}, {"by": ("sample",)}, {"min_base_quality": 25}):
        assert listed(call.locus_sums(pile, 2, **more)) == listed(call.locus_sums(rows, 2, **more))
    assert listed(pileup.site_counts(pile)) == listed(pileup.site_counts(rows))
    letters = list("ACGT")
    wrong = rows.filter(F.col("base").isin(letters) & F.col("ref_base").isin(letters) & (F.col("base") != F.col("ref_base")))
    want = wrong.groupBy("contig_idx", "pos").agg(F.sum(F.col("q").cast("bigint")).alias("m"))
    assert listed(pileup.origin(pile).summed(["contig_idx"], batches.mismatch_sums(["contig_idx"], quality), ["m"])) == listed(want)


def test_sums_make_no_row_of_a_base(data):
    plan = lambda df: df._jdf.queryExecution().toString()
    pile = pileup.pileup(*data)
    for df in (call.locus_sums(pile, 2), pileup.site_counts(pile), recalibrate.bqsr_table(data[0], data[0].select("contig_idx", "pos").limit(3), data[1])):
        assert "MapInArrow" in plan(df) and "explode(sequence(_lo" not in plan(df)


def test_qualities_of_batches_are_those_of_joined_tables(data, monkeypatch):
    df, blocks = data
    table = recalibrate.bqsr_table(df, df.filter("contig_idx = 5").select("contig_idx", "pos"), blocks)
    got = listed(recalibrate.bqsr_apply(df, table).drop("read_group"))
    monkeypatch.setattr(recalibrate, "_few", lambda tables: None)
    assert got == listed(recalibrate.bqsr_apply(df, table).drop("read_group"))


@pytest.mark.parametrize("n, quality", [(1, 0), (4, 10), (9, 10)])
def test_first_bases_of_reads_are_those_of_rows(data, n, quality, monkeypatch):
    monkeypatch.setattr(batches, "AT_ONCE", 1000)  # several parts, and bins that are thinned while they are gathered
    pile = pileup.pileup(*data, quality, more=("sample",))
    got, want = pileup.downsample_coverage(pile, n), pileup.downsample_coverage(pile.filter("true"), n)
    assert got.dtypes == want.dtypes and listed(got) == listed(want)
    assert "_salt" not in got._jdf.queryExecution().toString()


def test_letters_of_any_alphabet():
    import pyarrow as pa
    column = pa.array(["zz", None, "aß", "", "漢b"])[1:]
    data, starts = arrays.ascii_letters(column)
    assert bytes(data) == b"a??b" and list(starts) == [0, 0, 2, 2, 4]
    data, starts = arrays.code_points(column)
    assert list(data) == [*map(ord, "aß漢b")] and list(starts) == [0, 0, 2, 2, 4]
