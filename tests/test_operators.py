"""Operators against brute force on small data, and invariants."""

import random

import pytest
from pyspark.sql import functions as F

from strandweave.checks.fixtures import Fixture
from strandweave.functions import cigar as C
from strandweave.functions import intervals as I
from strandweave.functions import scaling as S
from strandweave.operators import align, dedup, groom, pileup, realign, recalibrate
from strandweave.operators import reference as R

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SF)


def test_cigar_walk(spark):
    df = spark.createDataFrame([("3H2S4M1I3M2D5M1S2H", 100), ("10M", 100), ("5M100N5M", 100)], "cigar string, pos int")
    rows = df.select(C.cigar_segments(F.col("cigar")).alias("s"), C.reference_end(F.col("pos"), F.col("cigar")).alias("e"),
                     C.five_prime(F.col("pos"), F.col("cigar"), F.lit(False)).alias("f"),
                     C.five_prime(F.col("pos"), F.col("cigar"), F.lit(True)).alias("r")).collect()
    segs = [(s.op, s.len, s.read_off, s.ref_off) for s in rows[0].s]
    assert segs == [("H", 3, 0, 0), ("S", 2, 0, 0), ("M", 4, 2, 0), ("I", 1, 6, 4), ("M", 3, 7, 4), ("D", 2, 10, 7),
                    ("M", 5, 10, 9), ("S", 1, 15, 14), ("H", 2, 16, 14)]
    assert (rows[0].e, rows[0].f, rows[0].r) == (113, 95, 116)
    assert (rows[1].e, rows[1].f, rows[1].r) == (109, 100, 109)
    assert rows[2].e == 209


def ranges(rng, n, longest):
    rows = []
    for _ in range(n):
        a = rng.randint(1, 900)
        rows.append((rng.randint(0, 1), a, a + rng.randint(0, longest)))
    return rows


def test_overlap_join_merge_and_coverage(spark):
    rng = random.Random(5)
    left, right = ranges(rng, 60, 80), ranges(rng, 25, 120)
    l = spark.createDataFrame(left, "contig_idx int, start int, end int")
    r = spark.createDataFrame(right, "contig_idx int, start int, end int")
    got = sorted((x.contig_idx, x.start, x.end, x.iv_start, x.iv_end) for x in I.overlap_join(l, r, width=16).collect())
    assert got == sorted((a[0], a[1], a[2], b[1], b[2]) for a in left for b in right
                         if a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2])
    semi = sorted(tuple(x) for x in I.semi_overlap(l, r, "start", "end").collect())
    assert semi == sorted(a for a in left if any(a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2] for b in right))
    merged = I.merge_intervals(r).collect()
    assert {(m.contig_idx, p) for m in merged for p in range(m.start, m.end + 1)} == \
        {(b[0], p) for b in right for p in range(b[1], b[2] + 1)}
    again = I.merge_many(r.repartition(9)).collect()
    assert sorted((m.contig_idx, m.start, m.end) for m in again) == sorted((m.contig_idx, m.start, m.end) for m in merged)
    depth = {}
    for c, a, b in left:
        for p in range(a, b + 1):
            depth[c, p] = depth.get((c, p), 0) + 1
    runs = I.coverage_runs(l, width=37).collect()
    assert {(x.contig_idx, p): x.depth for x in runs for p in range(x.start, x.end + 1)} == depth


def test_top_n_lookup_and_ordinals(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.col("id").cast("string").alias("n"))
    kept = S.top_n_per_group(df, ["g"], [F.col("v").desc()], 7, ["n"], salts=4)
    want = {(g, v) for g in range(3) for v in sorted((i for i in range(1000) if i % 3 == g), reverse=True)[:7]}
    assert {(r.g, r.v) for r in kept.collect()} == want
    small = spark.createDataFrame([(0, "a"), (1, "b")], "g bigint, x string")
    a = sorted(map(tuple, S.lookup_join(df, small, ["g"], ["n"], "left").collect()), key=str)
    b = sorted(map(tuple, S.lookup_join(df, small, ["g"], ["n"], "left", max_rows=1, salts=4).collect()), key=str)
    assert a == b and len(a) == 1000
    for parts in (1, 7):
        rows = S.dense_ordinal(df.repartition(parts), "n").orderBy("n").collect()
        assert [r.ordinal for r in rows] == list(range(1000))


def test_reference_pieces_of_long_reads(spark):
    seq = "".join(random.Random(1).choice("ACGT") for _ in range(230))
    contigs = spark.createDataFrame([(0, "c", seq)], "contig_idx int, contig string, seq string")
    blocks = R.reference_blocks(contigs, 20, 10)
    reads = spark.createDataFrame([(0, 5, "8M"), (0, 18, "11M"), (0, 3, "200M"), (0, 221, "10M")], "contig_idx int, pos int, cigar string")
    rows = R.reference_pieces(reads, blocks, 20, 10).collect()
    seen = {}
    for r in rows:
        assert r.ref_seq == seq[r.ref_from - 1:r.ref_to]
        for p in range(r.ref_from, r.ref_to + 1):
            assert (r.pos, p) not in seen
            seen[r.pos, p] = 1
    assert len(seen) == 8 + 11 + 200 + 10
    sites = spark.createDataFrame([(0, p) for p in (1, 20, 21, 30, 230)], "contig_idx int, pos int")
    for b in R.mask_blocks(blocks, sites, 20, 10).collect():
        want = "".join("N" if p + 1 in (1, 20, 21, 30, 230) else c for p, c in enumerate(seq))
        assert b.seq == want[b.start - 1:b.start + 29]


def edits(read, text, begin, gap):
    """Every break of one gap: (mismatches, break)."""
    n, held = len(read), max(-gap, 0)
    for b in range(1, n - held):
        ref = text[begin:begin + b] + ("" if gap < 0 else "") + text[begin + b + max(gap, 0):]
        rest = read[b + held:]
        other = ref[b:b + len(rest)]
        if begin < 0 or len(other) < len(rest):
            continue
        yield sum(x != y for x, y in zip(read[:b], ref[:b])) + sum(x != y for x, y in zip(rest, other)), b


def test_gapped_alignment_against_brute_force(spark):
    rng = random.Random(11)
    text = "".join(rng.choice("ACGT") for _ in range(1500))
    contigs = spark.createDataFrame([(0, "c", text)], "contig_idx int, contig string, seq string")
    blocks = R.reference_blocks(contigs)
    reads, truth = [], {}
    for i in range(12):
        p, b, g = rng.randint(5, 1400), rng.randint(18, 30), rng.choice([-4, -2, 3, 6])
        seq = text[p:p + b] + ("TTGACC"[:-g] if g < 0 else "") + text[p + b + max(g, 0):][:50 - b - max(-g, 0)]
        if i % 2:
            seq = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
        reads.append((f"q{i}", 1, seq, [30] * 50))
        truth[f"q{i}"] = (p, g, "-" if i % 2 else "+")
    df = spark.createDataFrame(reads, "read_name string, mate int, seq string, quals array<int>")
    hits = {r.read_name: r for r in align.align_reads(df, blocks).collect() if "D" in r.cigar or "I" in r.cigar}
    assert len(hits) >= 10
    for name, hit in hits.items():
        seq = next(r[2] for r in reads if r[0] == name)
        if hit.strand == "-":
            seq = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
        best = min((nm, abs(g), begin, b) for begin in range(1500 - 45) for g in (-4, -2, 3, 6, hit_gap(hit.cigar))
                   for nm, b in edits(seq, text, begin, g)
                   if begin in range(truth[name][0] - 12, truth[name][0] + 13))
        assert (hit.nm, hit.strand) == (best[0], truth[name][2])
        assert hit.nm == min(nm for nm, b in edits(seq, text, hit.pos - 1, hit_gap(hit.cigar)))


def test_short_and_long_reads_are_placed(spark):
    rng = random.Random(12)
    text = "".join(rng.choice("ACGT") for _ in range(6500))
    text = text[:5000] + text[1200:2100] + text[5900:]  # 900 bases twice
    blocks = R.reference_blocks(spark.createDataFrame([(0, "c", text)], "contig_idx int, contig string, seq string"))
    turn = lambda t: t[::-1].translate(str.maketrans("ACGT", "TGCA"))
    other = lambda t, *at: "".join("ACGT"["ACGT".index(x) - 1] if i in at else x for i, x in enumerate(t))
    want = {"usual": {("+", 301, 0, "100M")}, "short": {("+", 701, 0, "15M")}, "short-": {("-", 6486, 0, "15M")},
            "499": {("+", 11, 2, "499M")}, "long": {("-", 901, 3, "2500M")}, "end": {("+", 4501, 0, "2000M")},
            "twice": {("+", 1251, 1, "700M"), ("+", 5051, 1, "700M")}, "gap": {("+", 2101, 1, "1000M3D500M")},
            "insertion": {("-", 3001, 0, "600M2I600M")}, "start": {("+", 1, 0, "700M4D1500M")}}
    seqs = {"usual": text[300:400], "short": text[700:715], "short-": turn(text[-15:]), "499": other(text[10:509], 3, 400),
            "long": turn(other(text[900:3400], 5, 999, 2400)), "end": text[4500:], "twice": other(text[1250:1950], 350),
            "gap": other(text[2100:3100] + text[3103:3603], 1400), "insertion": turn(text[3000:3600] + "GT" + text[3600:4200]),
            "start": text[:700] + text[704:2204], "nowhere": "ACGT" * 200, "wrong": other(text[100:900], 100, 200, 300, 400, 500), "none": ""}
    df = spark.createDataFrame([(n, 1, q, [30] * len(q)) for n, q in seqs.items()], "read_name string, mate int, seq string, quals array<int>")
    for more in ({}, {"max_read": 100}):
        got = {}
        for r in align.align_reads(df, blocks, **more).collect():
            got.setdefault(r.read_name, set()).add((r.strand, r.pos, r.nm, r.cigar))
        same = lambda hits: {(s, p, nm, "".join(c for c in g if c.isalpha())) for s, p, nm, g in hits}
        assert {n: same(h) for n, h in got.items()} == {n: same(h) for n, h in want.items()}
        for n in ("usual", "short", "short-", "499", "long", "end", "twice"):
            assert got[n] == want[n], n


def hit_gap(cigar):
    import re
    n, op = re.search(r"(\d+)([ID])", cigar).groups()
    return int(n) if op == "D" else -int(n)


def test_pairing_and_single_end(spark):
    rows = [("a", 1, "+", 0, 100, 0, "50M", 1), ("a", 2, "-", 0, 220, 0, "50M", 1), ("a", 2, "-", 0, 900, 0, "50M", 1),
            ("b", 1, "-", 0, 300, 1, "50M", 2), ("b", 2, "+", 0, 150, 0, "50M", 1), ("b", 2, "-", 0, 150, 0, "50M", 1)]
    hits = spark.createDataFrame(rows, "read_name string, mate int, strand string, contig_idx int, pos int, nm int, cigar string, n_loci bigint")
    pairs = {(r.read_name, r.mate): r for r in align.pair_alignments(hits, median_insert=170).collect()}
    assert (pairs["a", 1].pos, pairs["a", 2].pos, pairs["a", 1].tlen, pairs["a", 2].tlen) == (100, 220, 170, -170)
    assert (pairs["b", 1].flag, pairs["b", 2].flag) == (1 + 2 + 16 + 64, 1 + 2 + 32 + 128)
    assert pairs["b", 1].tlen == -200
    single = {(r.read_name, r.mate): r for r in align.select_single_end(hits).collect()}
    assert (single["a", 2].mapq, single["a", 2].n_best, single["a", 1].mapq, single["b", 1].mapq) == (0, 2, 60, 0)


def test_realignment_moves_planted_reads(fx):
    targets = realign.realign_targets(fx.alignments, fx.known_indels)
    before = fx.alignments
    after = realign.realign_indels(before, targets, fx.blocks, fx.known_indels, lod=1.0)
    moved = before.select("read_name", "mate", "fid", F.col("cigar").alias("old"), F.col("pos").alias("p")) \
        .join(after.select("read_name", "mate", "cigar", "pos", "contig_idx"), ["read_name", "mate"]).filter("old <> cigar")
    rows = moved.join(fx.hosts.select("contig_idx", "anchor"), "contig_idx").collect()
    assert len(rows) > 50
    planted = [r for r in rows if r.fid % 2 == 1 and 31 <= r.anchor - r.p + 1 <= 40]
    assert len(planted) > 0.9 * len(rows)
    right = [r for r in planted if r.cigar.startswith(f"{r.anchor - r.p + 1}M3") and r.pos == r.p]
    assert len(right) > 0.9 * len(planted)
    assert after.count() == before.count()


def test_marking_is_idempotent_and_removal_keeps_one(fx):
    once = dedup.mark_duplicates(fx.alignments)
    twice = dedup.mark_duplicates(once)
    assert once.select("read_name", "mate", "flag").exceptAll(twice.select("read_name", "mate", "flag")).isEmpty()
    kept = dedup.mark_duplicates(fx.alignments, remove=True)
    assert kept.count() == once.filter(F.col("flag").bitwiseAND(F.lit(1024)) == 0).count()
    assert dedup.duplication_metrics(kept).agg(F.sum("pair_duplicates")).first()[0] == 0


def test_mate_lengths_cancel(fx):
    fixed = groom.fix_mate_info(fx.dirty)
    assert fixed.groupBy("read_name").agg(F.sum("tlen").alias("t")).filter("t <> 0").isEmpty()


def test_split_and_merge_is_identity(fx):
    rows = fx.alignments.drop("tags")
    merged = groom.merge_alignments(rows.filter("fid % 3 = 0"), rows.filter("fid % 3 <> 0"))
    assert merged.exceptAll(rows).isEmpty() and merged.count() == rows.count()
    assert groom.merge_alignments(rows) is rows


def test_caps_and_restrictions_that_do_not_bind(fx):
    pile = pileup.pileup(fx.alignments, fx.blocks)
    assert pileup.downsample_coverage(pile, 10_000) is pile
    assert pileup.restrict_to_intervals(fx.alignments, None) is fx.alignments
    assert recalibrate.bqsr_apply(fx.alignments) is fx.alignments


def test_results_do_not_depend_on_partitions(spark, fx):
    from strandweave.operators import call
    base = call.call_snps(pileup.pileup(fx.alignments, fx.blocks))
    other = call.call_snps(pileup.pileup(fx.alignments.repartition(5), fx.blocks.repartition(3)))
    assert base.exceptAll(other).isEmpty() and other.exceptAll(base).isEmpty()


def test_every_order_gives_two_reads(spark, fx):
    assert fx.alignments.count() == 2 * fx.table("orders").count()
    letters = fx.table("documents").selectExpr("sum(regexp_count(text, r'\\p{L}')) n").first()["n"]
    assert fx.contigs.selectExpr("sum(contig_len) n").first()["n"] == letters


def test_duplicates_without_a_library(spark, fx):
    one = fx.alignments.filter("mate = 1 and read_name in ('r1', 'r2')").limit(1)
    from strandweave import model as M
    group = F.lit(None).cast(one.schema["read_group"].dataType)
    rows = one.select(*one.columns).withColumn("read_group", group)
    copies = rows.crossJoin(spark.createDataFrame([("a",), ("b",), ("c",)], "n string")).withColumn("read_name", F.col("n")).drop("n")
    other = copies.filter("read_name = 'a'").withColumn("read_name", F.lit("z")).withColumn("pos", F.col("pos") + 7)
    marked = {r.read_name: bool(r.flag & M.DUPLICATE) for r in dedup.mark_duplicates(copies.unionByName(other)).collect()}
    assert marked == {"a": False, "b": True, "c": True, "z": False}
    assert dedup.mark_duplicates(copies.unionByName(other), remove=True).count() == 2
    assert [r.library for r in dedup.duplication_metrics(copies).collect()] == [dedup.NO_LIBRARY]


def test_library_size_of_few_copies(spark):
    size = dedup.library_size(F.lit(10_000_000), F.lit(9_999_999))
    found = spark.range(1).select(size.alias("s")).first()["s"]
    assert found > 10 ** 13  # far more than a million molecules a read


def test_known_indel_candidates(spark):
    rows = [(0, 10, "CAT", "CAT"), (0, 20, "CAT", "GAT"), (0, 30, "ACGT", "ACGTTGC"), (0, 40, "ACGT", "AT"), (0, 50, "ACG", "TA")]
    known = spark.createDataFrame(rows, "contig_idx int, pos int, ref string, alt string")
    got = sorted((r.pos, r.gone, r.ins) for r in realign._known(known).collect())
    assert got == [(33, 0, "TGC"), (40, 2, ""), (49, 3, "TA")]


def test_close_removes_what_the_run_stored(spark, monkeypatch):
    import os
    monkeypatch.setattr(S, "_folders", {})  # a folder of this test alone
    kept = S.stored(spark.range(5), "five")
    folder = S.run_folder(spark).removeprefix("file:")
    assert kept.count() == 5 and os.listdir(folder)
    S.close(spark)
    assert not os.path.exists(folder)
