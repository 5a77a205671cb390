"""One form for equivalent indels, and genotypes over several alternates."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from strandweave.checks import oracles, registry
from strandweave.operators import call, multiallelic, normalize
from strandweave.operators.reference import reference_blocks

SF = "/root/testdata/sf0.001"
EVENT = "contig_idx int, contig string, pos int, op string, len int, ins string"


def shifted(seq, pos, op, n, ins):
    """Moved one base at a time."""
    text = ins if op == "I" else seq[pos:pos + n]
    while pos > 1 and seq[pos - 1] == text[-1]:
        pos, text = pos - 1, text[-1] + text[:-1]
    return pos, op, n, text if op == "I" else ""


@pytest.mark.parametrize("window", [3, 100])
def test_left_normalized_against_single_steps(spark, window):
    r = random.Random(6)
    seqs = ["".join(r.choice("AC") for _ in range(400)), "A" * 1500 + "C" + "GT" * 800 + "ACGT", "ACG" * 120]
    events = set()
    for c, s in enumerate(seqs):
        for _ in range(150):
            pos, n = r.randrange(1, len(s) - 8), r.randrange(1, 7)
            if r.random() < 0.5:
                events.add((c, "c", pos, "D", n, ""))
            else:
                at = r.randrange(max(0, pos - 3), pos)
                events.add((c, "c", pos, "I", n, (s[at:at + n] + "T" * n)[:n]))
    blocks = reference_blocks(spark.createDataFrame([(c, "c", s) for c, s in enumerate(seqs)], "contig_idx int, contig string, seq string"))
    got = normalize.left_normalized(spark.createDataFrame(sorted(events), EVENT), blocks, window).collect()
    want = [(c, *shifted(seqs[c], *e)) for c, _, *e in events]
    assert sorted((x.contig_idx, x.pos, x.op, x.len, x.ins) for x in got) == sorted(want)
    assert normalize.left_normalized(spark.createDataFrame([], EVENT), blocks).count() == 0


def test_two_alternates_are_called(spark):
    rows = registry.queries()["call_snp_alleles"](spark, SF).filter("(pos * 31 + contig_idx * 17) % 211 = 0 and pos % 2 = 0 and dp >= 6")
    found = rows.groupBy("gt").count().collect()
    assert max(found, key=lambda x: x["count"])["gt"] == "1/2"
    assert rows.filter("gt = '1/2' and (not alt like '_,_' or size(split(ad, ',')) <> 3)").count() == 0


def test_indel_alleles_written_to_one_reference(spark):
    seq = "ACGTTGCAAGCTTACGGATCCATGCAAGTC" * 3
    reads = [(f"d{i}", 0, 0, "c", 1, "30M3D20M", 50) for i in range(6)] + [(f"i{i}", 0, 0, "c", 1, "30M2I18M", 50) for i in range(6)]
    reads += [(f"l{i}", 0, 0, "c", 31, "4I46M", 50) for i in range(1)] + [("r", 0, 0, "c", 1, "50M", 50)]
    df = spark.createDataFrame([(n, 1, f, c, k, p, g, "A" * 50, [30] * m) for n, f, c, k, p, g, m in reads],
                               "read_name string, mate int, flag int, contig_idx int, contig string, pos int, cigar string, seq string, quals array<int>")
    blocks = reference_blocks(spark.createDataFrame([(0, "c", seq)], "contig_idx int, contig string, seq string"))
    events = call.indel_events(df).collect()
    assert {(e.pos, e.op, e.len) for e in events} == {(30, "D", 3), (30, "I", 2), (30, "I", 4)}  # the leading one too
    row = multiallelic.call_indel_alleles(df, blocks).first()
    assert row.gt == "1/2" and row.pos == 30 and row.ref == seq[29:33] and set(row.alt.split(",")) == {"C", "CAA" + seq[30:33]}
    assert row.dp == 14 and row.ad == "1,6,6"
    assert multiallelic.call_indel_alleles(df.filter("false"), blocks).count() == 0


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_runs_cover_every_contig_once(spark, con):
    rows = registry.queries()["reference_runs"](spark, SF)
    per = rows.groupBy("contig_idx").agg(F.sum(F.col("end") - F.col("start") + 1).alias("n"), F.min("start").alias("a"), F.max("end").alias("z"))
    lengths = dict(con.sql(oracles.with_chain("SELECT contig_idx, contig_len FROM contigs")).fetchall())
    assert {r.contig_idx: (r.n, r.a, r.z) for r in per.collect()} == {c: (n, 1, n) for c, n in lengths.items()}
