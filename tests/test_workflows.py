"""Reads to variants end to end."""

import duckdb
from pyspark.sql import functions as F

from strandweave.checks.fixtures import Fixture
from strandweave.checks.oracles import SELECT_SINGLE_END
from strandweave.plans import workflows

SF = "/root/testdata/sf0.001"


def test_reads_to_variants(spark):
    fx = Fixture(spark, SF)
    left, right = (fx.reads.filter(F.col("mate") == m) for m in (1, 2))
    out = workflows.reads_to_variants(left, right, fx.contig_lengths, fx.blocks, fx.known_snps, fx.known_indels, fx.known_snps)
    final = out["alignments"]
    assert final.count() == fx.reads.count()
    truth = fx.alignments.select("read_name", "mate", F.col("contig_idx").alias("c"), F.col("pos").alias("p"))
    placed = final.filter("mapq > 0").join(truth, ["read_name", "mate"])
    right_place = placed.filter("contig_idx = c AND abs(pos - p) <= 3").count()
    assert right_place > 0.97 * placed.count()
    # SQL counts the reads with one ungapped best place; those with a gap come on top
    con = duckdb.connect()
    for t in ("documents", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    unique = con.sql(f"SELECT count(*) FROM ({SELECT_SINGLE_END}) WHERE mapq > 0").fetchall()[0][0]
    assert placed.filter("NOT cigar RLIKE '[ID]'").count() <= unique <= placed.count()
    snps = out["snps"].collect()
    # depth is about 3 here: even true alignments give only 66 calls once qualities are recalibrated
    assert snps
    assert sum(r.id != "." for r in snps) > 0.8 * len(snps)
    assert out["indels"].count() > 5
    row = out["caller_metrics"].first()
    assert row.visited >= row.callable >= row.confident >= row.variants > 0


def test_alignments_to_metrics(spark):
    fx = Fixture(spark, SF)
    options = workflows.RunOptions(skip=frozenset({"refine", "call"}))
    out = workflows.alignments_to_variants(fx.alignments, fx.contig_lengths, fx.blocks, fx.known_snps, None,
                                           fx.known_snps, fx.baits, fx.targets, options)
    assert {"hs_metrics", "gc_bias", "insert_size_metrics", "duplication_metrics"} <= set(out)
    assert out["hs_metrics"].first().bases > 0
    assert "snps" not in out
