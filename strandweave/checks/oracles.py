"""SQL for the registered queries, over the derivation chain of ``fixture_sql``."""

from ..operators.call import INDEL_QUALITY, INDEL_THETA, SNP_THETA, log_priors
from ..operators.multiallelic import pair_priors
from .fixture_sql import with_chain


def _error(q: str) -> str:
    return f"power(10.0, -greatest({q}, 1) / 10.0)"


def _term(k: int, ploidy: int, q: str) -> str:
    e = _error(q)
    return f"CAST(floor(log10({ploidy - k}.0 / {ploidy} * (1 - {e}) + {k}.0 / {ploidy} * {e} / 3) * 1000000 + 0.5) AS BIGINT)"


def _model(sums: list[str], theta: float, ploidy: int) -> tuple[str, str, str]:
    """SQL for (qual, ref_qual, gt) from likelihood sums in millionths."""
    p = [f"({s} / 1000000.0::DOUBLE + {repr(v)}::DOUBLE)" for s, v in zip(sums, log_priors(ploidy, theta))]

    def log_sum(values):
        top = f"greatest({', '.join(values)})"
        return f"({top} + log10({' + '.join(f'power(10.0, {v} - {top})' for v in values)}))"

    best = f"greatest({', '.join(p[1:])})"
    gt = "CASE " + " ".join(
        f"WHEN {p[k]} = {best} THEN '{'/'.join(['0'] * (ploidy - k) + ['1'] * k)}'" for k in range(1, ploidy + 1)) + " END"
    return f"round(({log_sum(p)} - {p[0]}) * 10, 2)", f"round(({p[0]} - {log_sum(p[1:])}) * 10, 2)", gt


PILE = """
pile_all AS (
  SELECT contig_idx, contig, rpos pos, ref_base, read_name, mate, base, q FROM bases WHERE rpos IS NOT NULL
  UNION ALL
  SELECT d.contig_idx, d.contig, d.pos, r.ref_base, d.read_name, d.mate, '*', NULL
  FROM (SELECT contig_idx, contig, CAST(anchor + g AS INT) pos, read_name, mate
        FROM (SELECT al.*, pos0 + a anchor FROM alignments al WHERE gapped AND deletes) x
        CROSS JOIN (VALUES (1), (2), (3)) v(g)) d
  JOIN ref_bases r ON r.contig_idx = d.contig_idx AND r.rpos = d.pos)"""
PILE10 = "pile AS (SELECT * FROM pile_all WHERE q IS NULL OR q >= 10)"


def _sites(ploidy: int, source: str = "pile") -> list[str]:
    ks = range(ploidy + 1)
    sums = [f"(coalesce(r.s{k}, 0) + coalesce(o.s{ploidy - k}, 0))" for k in ks]
    qual, ref_qual, gt = _model(sums, SNP_THETA, ploidy)
    return [
        f"""letters AS (SELECT contig_idx, contig, pos, ref_base, base, count(*) n,
             {', '.join(f"CAST(sum({_term(k, ploidy, 'q')}) AS BIGINT) s{k}" for k in ks)}
             FROM {source} WHERE q >= 10 GROUP BY ALL)""",
        """loci AS (SELECT DISTINCT contig_idx, contig, pos, ref_base FROM letters)""",
        """others AS (SELECT * FROM letters WHERE base <> ref_base
             QUALIFY row_number() OVER (PARTITION BY contig_idx, pos ORDER BY n DESC, base) = 1)""",
        f"""sites AS (SELECT l.contig_idx, l.contig, l.pos, l.ref_base ref, coalesce(o.base, '.') alt,
             CASE WHEN o.base IS NULL THEN 0.0::DOUBLE ELSE {qual} END qual, {ref_qual} ref_qual,
             CASE WHEN o.base IS NULL THEN '{'/'.join(['0'] * ploidy)}' ELSE {gt} END gt,
             coalesce(r.n, 0) + coalesce(o.n, 0) dp, coalesce(o.n, 0) ad
             FROM loci l
             LEFT JOIN letters r ON r.contig_idx = l.contig_idx AND r.pos = l.pos AND r.base = l.ref_base
             LEFT JOIN others o ON o.contig_idx = l.contig_idx AND o.pos = l.pos)""",
        """snps AS (SELECT contig_idx, contig, pos, ref, alt, qual, gt, dp, ad FROM sites WHERE qual >= 30 AND alt <> '.')""",
    ]


#: Events (op, the text t that goes or comes, ad) moved left one base at a time; b is the base before.
_SHIFTED = [
    """shifts(contig_idx, contig, op, ad, pos_0, t_0, pos, t) AS (
         SELECT contig_idx, contig, op, ad, pos, t, pos, t FROM events
         UNION ALL SELECT s.contig_idx, s.contig, op, ad, pos_0, t_0, pos - 1, right(t, 1) || left(t, length(t) - 1)
         FROM shifts s JOIN contigs c ON c.contig_idx = s.contig_idx WHERE pos > 1 AND substr(c.seq, pos, 1) = right(t, 1))""",
    """normal AS (SELECT s.contig_idx, s.contig, op, t, CAST(pos AS INT) pos, ad, substr(c.seq, pos, 1) b FROM (
         SELECT * FROM shifts QUALIFY row_number() OVER (PARTITION BY contig_idx, pos_0, t_0, op ORDER BY pos) = 1) s
         JOIN contigs c ON c.contig_idx = s.contig_idx)""",
]


def _recursive(sql: str) -> str:
    return sql.replace("WITH contigs", "WITH RECURSIVE contigs", 1)


def _pair_model(theta: float) -> str:
    """Prior of the pair (i, j) of alleles, 0 being the reference."""
    p = pair_priors(theta)
    return f"CASE WHEN j = 0 THEN {p['none']!r}::DOUBLE WHEN i = 0 THEN {p['one']!r}::DOUBLE WHEN i = j THEN {p['same']!r}::DOUBLE ELSE {p['both']!r}::DOUBLE END"


_BEST_PAIR = """best AS (SELECT *, round((m + log10(list_sum(list_transform(ps, lambda p: pow(10.0, p - m)))) - none) * 10, 2) qual FROM (
         SELECT contig_idx, pos, max(p) m, list(p ORDER BY i, j) ps, max(p) FILTER (j = 0) none, arg_max({'i': i, 'j': j}, (p, -i, -j)) g
         FROM pairs GROUP BY ALL))"""


def _indels(ploidy: int) -> list[str]:
    t = [_term(k, ploidy, str(INDEL_QUALITY)) for k in range(ploidy + 1)]
    sums = [f"((dp - ad) * {t[k]} + ad * {t[ploidy - k]})" for k in range(ploidy + 1)]
    qual, _, gt = _model(sums, INDEL_THETA, ploidy)
    return [
        """ins_seq AS (SELECT fid, mate, string_agg(base, '' ORDER BY i) ins FROM bases1 WHERE rpos IS NULL GROUP BY ALL)""",
        """events AS (SELECT g.contig_idx, g.contig, g.pos0 + g.a pos, CASE WHEN deletes THEN 'D' ELSE 'I' END op,
             CASE WHEN deletes THEN substr(c.seq, g.pos0 + g.a + 1, 3) ELSE s.ins END t, count(*) ad
             FROM alignments g JOIN contigs c ON c.contig_idx = g.contig_idx
             LEFT JOIN ins_seq s ON s.fid = g.fid AND s.mate = g.mate WHERE gapped GROUP BY ALL)""",
        *_SHIFTED,
        """indel_seen AS (SELECT contig_idx, contig, pos, CASE WHEN op = 'D' THEN b || t ELSE b END "ref", CASE WHEN op = 'D' THEN b ELSE b || t END alt,
             CAST(sum(ad) AS BIGINT) ad FROM normal GROUP BY ALL)""",
        """indel_ad AS (SELECT contig_idx, contig, pos, ref, alt, ad FROM (
             SELECT *, row_number() OVER (PARTITION BY contig_idx, pos ORDER BY ad DESC, ref, alt) rk FROM indel_seen) WHERE rk = 1)""",
        """indel_dp AS (SELECT i.contig_idx, i.contig, i.pos, i.ref, i.alt, i.ad, greatest(count(b.fid), any_value(i.ad)) dp FROM indel_ad i
             LEFT JOIN alignments b ON b.contig_idx = i.contig_idx AND b.pos <= i.pos AND b.ref_end > i.pos GROUP BY ALL)""",
        f"""indels AS (SELECT * FROM (
             SELECT contig_idx, contig, pos, ref, alt, {qual} qual, {gt} gt, dp, ad
             FROM indel_dp WHERE ad >= dp * 0.1) WHERE qual >= 30)""",
    ]


READ_FASTQ = with_chain("""SELECT read_name, mate, seq, qual,
  row_number() OVER (PARTITION BY mate ORDER BY fid) - 1 AS ordinal FROM raw_reads""")

_ORDER = "contig_order AS (SELECT contig_idx, CAST(row_number() OVER (ORDER BY contig_idx) - 1 AS INT) place FROM contigs)"
_ALN_SEQ = """aln_seq AS (SELECT a.*, s.seq, s.qual FROM alignments a JOIN (
  SELECT fid, mate, string_agg(base, '' ORDER BY i) seq, string_agg(chr(q + 33), '' ORDER BY i) qual
  FROM bases1 GROUP BY fid, mate) s ON s.fid = a.fid AND s.mate = a.mate)"""

READ_SAM = with_chain("""SELECT read_name, mate, flag, place AS contig_idx, contig, pos, mapq, cigar, mate_contig, mate_pos,
  tlen, seq, qual, library, 'i:0' AS nm FROM aln_seq JOIN contig_order USING (contig_idx)""", _ORDER, _ALN_SEQ)

READ_SAM_HEADER = with_chain("""SELECT record_type, count(*) * 2 AS "lines", CAST(sum(strlen(line) + 1) * 2 AS BIGINT) AS bytes,
  CAST(sum(len) * 2 AS BIGINT) AS total_length FROM header GROUP BY record_type
  UNION ALL SELECT 'all', count(*) * 2, CAST(sum(strlen(line) + 1) * 2 AS BIGINT), NULL FROM header""", """header AS (
  SELECT 'HD' record_type, concat('@HD', chr(9), 'VN:1.6', chr(9), 'SO:coordinate') line, NULL::BIGINT len
  UNION ALL SELECT 'SQ', concat('@SQ', chr(9), 'SN:', contig, chr(9), 'LN:', contig_len), contig_len FROM contigs
  UNION ALL SELECT DISTINCT 'RG', concat('@RG', chr(9), 'ID:', read_group, chr(9), 'SM:s1', coalesce(chr(9) || 'LB:' || library, ''),
    chr(9), 'PL:ILLUMINA', chr(9), 'PU:1'), NULL::BIGINT FROM alignments)""")

COUNT_CONTIGS = with_chain("SELECT count(*) AS contigs FROM contigs")

READ_REFERENCE = with_chain("""SELECT place AS contig_idx, contig, contig_len, CAST(b AS INT) AS block,
  CAST(b * 1000 + 1 AS INT) AS start, md5(substr(seq, b * 1000 + 1, 2000)) AS digest
  FROM (SELECT *, unnest(range((contig_len - 1) // 1000 + 1)) b FROM contigs) c JOIN contig_order USING (contig_idx)""", _ORDER)

READ_KNOWN_SITES = with_chain("""SELECT contig_idx, contig, pos, CASE WHEN pos % 3 = 0 THEN '.' ELSE id END AS id, ref, alt FROM known_snps
  UNION ALL SELECT contig_idx, contig, pos, CASE WHEN pos % 3 = 0 THEN '.' ELSE id END, ref, translate(ref, 'ACGT', 'CATG')
  FROM known_snps WHERE pos % 2 = 0""")

READ_INTERVALS = with_chain("""SELECT contig, start_pos AS start, end_pos AS "end", name, 'target' AS kind FROM targets
  UNION ALL SELECT contig, start_pos, end_pos, name, 'bait' FROM baits""")

WRITE_ALIGNMENTS = with_chain("""SELECT read_name, mate, flag, contig_idx, pos, ref_end, mapq, cigar, mate_pos, tlen, seq, qual
  FROM aln_seq""", _ALN_SEQ)

REGION_SCAN = with_chain("""SELECT read_name, mate, a.contig_idx, pos, cigar FROM alignments a
  JOIN (SELECT contig_idx, contig_len FROM contigs ORDER BY contig_len DESC, contig_idx LIMIT 1) t
  ON a.contig_idx = t.contig_idx AND pos <= t.contig_len // 2 AND ref_end >= 1""")

WRITE_VARIANTS = with_chain("""SELECT s.contig, s.pos, '.' AS id, ref, alt, count(*) AS depth,
  CASE WHEN gt = '0/1' THEN round((dp - ad) / dp::DOUBLE, 6) END AS allele_balance,
  round(count(*) FILTER (p.base = '*') / count(*)::DOUBLE, 6) AS spanning_deletions FROM snps s
  JOIN pile_all p ON p.contig_idx = s.contig_idx AND p.pos = s.pos GROUP BY ALL""", PILE, PILE10, *_sites(2))

CHUNK_READS = with_chain("""SELECT read_name, mate, o AS ordinal, o // 1000 AS chunk
  FROM (SELECT *, row_number() OVER (PARTITION BY mate ORDER BY fid) - 1 o FROM alignments)""")

CHUNK_ALIGNMENTS = with_chain("""SELECT CAST(n AS INT) AS n, chunk, count(*) AS alignments, any_value(h) AS header_lines,
  arg_min(contig_idx, o) AS first_contig, arg_min(pos, o) AS first_pos
  FROM (SELECT n, o, contig_idx, pos, CASE WHEN n = 0 THEN 0 ELSE o // n END chunk FROM placed CROSS JOIN (VALUES (7000), (0)) v(n))
  CROSS JOIN (SELECT (SELECT count(*) FROM contigs) + (SELECT count(DISTINCT read_group) FROM alignments) + 1 h)
  GROUP BY n, chunk""", """placed AS (SELECT contig_idx, pos,
  row_number() OVER (ORDER BY contig_idx, pos, read_name, mate) - 1 o FROM alignments)""")

CHUNK_BY_BYTES = with_chain("""SELECT read_name, mate, "offset", "offset" * 10 // total AS chunk FROM (
  SELECT read_name, mate, CAST(coalesce(sum(b) OVER (ORDER BY contig_idx, pos, read_name, mate
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) "offset", CAST(sum(b) OVER () AS BIGINT) total
  FROM (SELECT *, strlen(read_name) + strlen(CAST(flag AS VARCHAR)) + strlen(contig) + strlen(CAST(pos AS VARCHAR))
    + strlen(cigar) + 50 + 6 b FROM alignments))""")

CONTIG_LENGTHS = with_chain("SELECT contig_idx, contig, contig_len FROM contigs")

SEQUENCE_WINDOWS = with_chain("""SELECT contig_idx, contig, CAST(k * 100 + 1 AS INT) AS start, substr(seq, k * 100 + 1, 120) AS seq
  FROM (SELECT *, unnest(range((greatest(contig_len - 20, 1) - 1) // 100 + 1)) k FROM contigs)""")

FIND_SUBSEQUENCE = with_chain("""SELECT contig_idx, contig, rpos AS pos FROM (
  SELECT contig_idx, contig, rpos, ref_base || lead(ref_base, 1) OVER w || lead(ref_base, 2) OVER w
    || lead(ref_base, 3) OVER w || lead(ref_base, 4) OVER w s
  FROM ref_bases WINDOW w AS (PARTITION BY contig_idx ORDER BY rpos)) WHERE s = 'GATTA'""")

SUBSEQUENCE = with_chain("SELECT contig_idx, contig, substr(seq, 101, 80) AS seq FROM contigs")

PAIR_MATES = with_chain("""SELECT coalesce(l.read_name, r.read_name) AS read_name, l.seq AS left_seq, r.seq AS right_seq,
  CASE WHEN r.seq IS NULL THEN 'left_only' WHEN l.seq IS NULL THEN 'right_only' ELSE 'paired' END AS status
  FROM (SELECT * FROM whole WHERE mate = 1) l FULL JOIN (SELECT * FROM whole WHERE mate = 2) r ON l.read_name = r.read_name""",
  "whole AS (SELECT * FROM raw_reads WHERE NOT regexp_matches(seq, 'A{5}|C{5}|G{5}|T{5}'))")

TRIM_READS = with_chain("""SELECT any_value(read_name) AS read_name, b.mate, coalesce(string_agg(base, '' ORDER BY i) FILTER (i < keep), '') AS seq,
  coalesce(string_agg(chr(q + 33), '' ORDER BY i) FILTER (i < keep), '') AS qual
  FROM raw_bases b JOIN cuts c ON c.fid = b.fid AND c.mate = b.mate GROUP BY b.fid, b.mate""",
  """tails AS (SELECT fid, mate, i, sum(20 - q) OVER (PARTITION BY fid, mate ORDER BY i DESC) s FROM raw_bases)""",
  """cuts AS (SELECT fid, mate, CASE WHEN s > 0 THEN i ELSE 50 END keep FROM tails
  QUALIFY row_number() OVER (PARTITION BY fid, mate ORDER BY s DESC, i DESC) = 1)""")

_HITS = [
    """tiles AS (SELECT contig_idx, contig_len, t * 1000 t0, substr(seq, t * 1000 + 1, 1100) s
       FROM (SELECT *, unnest(range((contig_len - 1) // 1000 + 1)) t FROM contigs))""",
    """kmers AS (SELECT contig_idx, contig_len, CAST(t0 + j + 1 AS INT) p, substr(s, j + 1, 16) kmer
       FROM (SELECT *, unnest(range(least(1000, length(s) - 15))) j FROM tiles WHERE length(s) >= 16))""",
    """strands AS (SELECT DISTINCT seq, '+' strand, seq turned FROM raw_reads
       UNION ALL SELECT DISTINCT seq, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM raw_reads)""",
    """seeds AS (SELECT *, substr(turned, o + 1, 16) kmer FROM strands CROSS JOIN (VALUES (0), (16), (32)) v(o))""",
    """spots AS (SELECT DISTINCT seq, strand, turned, k.contig_idx, k.p - o AS pos, contig_len FROM seeds s JOIN kmers k ON k.kmer = s.kmer
       WHERE k.p - o >= 1 AND k.p - o + 49 <= contig_len)""",
    """seen AS (SELECT s.*, hamming(turned, substr(t.s, CAST(s.pos - 1 - t.t0 + 1 AS BIGINT), 50)) nm
       FROM spots s JOIN tiles t ON t.contig_idx = s.contig_idx AND t.t0 = (s.pos - 1) // 1000 * 1000)""",
    """hits AS (SELECT r.read_name, r.mate, strand, CAST(nm AS INT) nm, contig_idx, CAST(pos AS INT) pos
       FROM seen JOIN raw_reads r ON r.seq = seen.seq WHERE nm <= 4)""",
]

ALIGN_READS = with_chain("SELECT read_name, mate, strand, nm, contig_idx, pos FROM hits", *_HITS)

SELECT_SINGLE_END = with_chain("""SELECT read_name, mate, contig_idx, pos, strand, nm, n_best, n_hits,
  CASE WHEN n_best > 1 THEN 0 ELSE 60 END AS mapq FROM (
  SELECT *, count(*) OVER (PARTITION BY read_name, mate) n_hits, count(*) OVER (PARTITION BY read_name, mate, nm) n_best,
    row_number() OVER (PARTITION BY read_name, mate ORDER BY nm, contig_idx, pos, strand) rk FROM hits) WHERE rk = 1""", *_HITS)

_PAIRS = """SELECT read_name, CAST(m AS INT) AS mate,
  CAST(CASE WHEN m = 1 THEN 67 + CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN strand2 = '-' THEN 32 ELSE 0 END
       ELSE 131 + CASE WHEN strand2 = '-' THEN 16 ELSE 0 END + CASE WHEN strand = '-' THEN 32 ELSE 0 END END AS INT) AS flag,
  contig_idx, CASE WHEN m = 1 THEN pos ELSE pos2 END AS pos, CASE WHEN m = 1 THEN nm ELSE nm2 END AS nm,
  CASE WHEN m = 1 THEN pos2 ELSE pos END AS mate_pos,
  CAST(CASE WHEN (m = 1) = (strand = '+') THEN size ELSE -size END AS INT) AS tlen
  FROM (SELECT *, CASE WHEN d >= 0 THEN d + 1 ELSE d - 1 END size FROM (
    SELECT read_name, x.contig_idx, x.pos, x.strand, x.nm, x.pos2, x.strand2, x.nm2, x.d FROM (
    SELECT a.read_name, min(struct_pack(k := a.nm + b.nm,
      off := abs(CASE WHEN a.strand = '+' THEN b.e - (a.pos + 169) ELSE b.pos - (a.e - 169) END),
      contig_idx := a.contig_idx, pos := a.pos, pos2 := b.pos, strand := a.strand, nm := a.nm, strand2 := b.strand, nm2 := b.nm,
      d := CASE WHEN a.strand = '+' THEN b.e - a.pos ELSE a.e - b.pos END)) x
    FROM places a JOIN places b ON a.read_name = b.read_name AND a.contig_idx = b.contig_idx AND a.mate = 1 AND b.mate = 2
      AND a.strand <> b.strand GROUP BY a.read_name)))
  CROSS JOIN (VALUES (1), (2)) v(m)"""
PAIR_ALIGNMENTS_OF_HITS = with_chain(_PAIRS, *_HITS, "places AS MATERIALIZED (SELECT *, pos + 49 e FROM hits)")
PAIR_ALIGNMENTS = with_chain(_PAIRS,
  """places AS (SELECT read_name, mate, contig_idx, CAST(pos + o AS INT) pos, ref_end + o e,
    CASE WHEN (mate = 1) = (o <> 23) THEN '+' ELSE '-' END strand,
    CAST(CASE o WHEN 0 THEN (fid + mate) % 3 WHEN 17 THEN (fid * 7 + mate) % 3 ELSE (fid * 5 + mate * 2) % 3 END AS INT) nm
    FROM alignments CROSS JOIN (VALUES (0), (17), (23)) v(o))""")

ATTACH_READ_GROUP = with_chain("""SELECT read_name, mate, 'run7' AS id, 'NA1' AS sample, 'libX' AS library,
  'ILLUMINA' AS platform, '1' AS unit FROM alignments""")

_DIRTY_END = "pos + ref_end - (pos0 + 1)"
CLEAN_ALIGNMENTS = with_chain(f"""SELECT read_name, mate, flag, pos, CASE WHEN fid % 50 = 0 THEN 0 ELSE mapq END AS mapq,
  CAST(CASE WHEN fid % 50 = 0 THEN {_DIRTY_END}
       WHEN {_DIRTY_END} > contig_len AND gapped AND deletes AND pos + a - 1 < contig_len AND pos + a + 2 >= contig_len THEN pos + a - 1
       ELSE least({_DIRTY_END}, contig_len) END AS INT) AS ref_end, 50 AS read_bases FROM dirty""")

SORT_BY_COORDINATE = with_chain("""SELECT read_name, mate, flag, contig_idx, pos,
  row_number() OVER (ORDER BY CASE WHEN flag & 4 <> 0 THEN 1 ELSE 0 END, contig_idx, pos, read_name, mate) AS place FROM dirty""")

MERGE_ALIGNMENTS = with_chain("""SELECT read_name, mate, flag, contig_idx, pos, CASE WHEN mate = 1 THEN mapq END AS mapq FROM alignments""")

GROOM = with_chain(f"""SELECT contig_idx, count(*) AS "rows", min(pos) AS first_pos, max(ref_end) AS last_end,
  CAST(sum(mapq) AS BIGINT) AS mapq_sum FROM ({CLEAN_ALIGNMENTS[CLEAN_ALIGNMENTS.rindex('SELECT read_name'):].replace('SELECT read_name', 'SELECT contig_idx, read_name', 1)})
  GROUP BY contig_idx""")

_FRAGS = """frags AS (SELECT a.fid, library, read_name, contig_idx, max(pos) FILTER (a.mate = 1) p1, max(ref_end) FILTER (a.mate = 2) p2, max(s) score
  FROM alignments a JOIN (SELECT fid, sum(q) s FROM bases1 WHERE q >= 15 GROUP BY fid) x ON x.fid = a.fid GROUP BY ALL)"""

MARK_DUPLICATES = with_chain("""SELECT a.read_name, mate, CASE WHEN rk > 1 THEN flag + 1024 ELSE flag END AS flag FROM alignments a
  JOIN (SELECT fid, row_number() OVER (PARTITION BY library, contig_idx, p1, p2 ORDER BY score DESC, read_name) rk FROM frags) f
  ON f.fid = a.fid""", _FRAGS)

DUPLICATION_METRICS = with_chain("""SELECT coalesce(library, 'unknown') AS library, n AS pairs, 0::BIGINT AS singles, n - c AS pair_duplicates,
  0::BIGINT AS single_duplicates, round((n - c) * 2 / (n * 2)::DOUBLE, 6) AS percent_duplication,
  CASE WHEN c < n THEN CAST(round(c * (lo + hi) / 2) AS BIGINT) END AS estimated_library_size
  FROM solve WHERE it = 60""", _FRAGS,
  "per_lib AS (SELECT library, CAST(sum(k) AS BIGINT) n, count(*) c FROM (SELECT library, count(*) k FROM frags GROUP BY library, contig_idx, p1, p2) GROUP BY library)",
  """solve AS (SELECT library, n, c, 1.0::DOUBLE lo, n::DOUBLE * n / (2::DOUBLE * c * greatest(n - c, 1)) + 1 hi, 0 it FROM per_lib
  UNION ALL SELECT library, n, c,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN hi ELSE (lo + hi) / 2 END, it + 1
  FROM solve WHERE it < 60)""").replace("WITH contigs", "WITH RECURSIVE contigs", 1)

_CLUSTERS = [
  """copies AS (SELECT fid, coalesce(library, 'unknown') library, fid % 5 % 2 tile, fid * 7919 % 4001 x, fid * 104729 % 4003 y, score,
    concat('m:1:f:1:', 1101 + fid % 5 % 2, ':', fid * 7919 % 4001, ':', fid * 104729 % 4003, '#r', fid) read_name,
    CASE WHEN fid % 4 = 0 THEN 'hot' ELSE concat(contig_idx, ' ', p1, ' ', p2) END place FROM frags)""",
  """beside AS (SELECT a.fid a, b.fid b FROM copies a JOIN copies b ON a.library = b.library AND a.place = b.place AND a.tile = b.tile
    AND abs(a.x - b.x) <= 100 AND abs(a.y - b.y) <= 100)""",
  "reached AS (SELECT a, b FROM beside UNION SELECT r.a, e.b FROM reached r JOIN beside e ON e.a = r.b)",
  """judged AS (SELECT c.*, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, read_name) > 1 optical
    FROM copies c JOIN (SELECT a, min(b) cluster FROM reached GROUP BY a) k ON k.a = c.fid)"""]

OPTICAL_DUPLICATES = with_chain("SELECT library, read_name, optical FROM judged", _FRAGS, *_CLUSTERS).replace("WITH contigs", "WITH RECURSIVE contigs", 1)

OPTICAL_METRICS = with_chain("""SELECT library, pairs, pairs - c AS pair_duplicates, pairs - n AS optical_pair_duplicates,
  CASE WHEN c < n THEN CAST(round(c * (lo + hi) / 2) AS BIGINT) END AS estimated_library_size FROM solve WHERE it = 60""", _FRAGS, *_CLUSTERS,
  "per_lib AS (SELECT library, count(*) pairs, count(*) FILTER (NOT optical) n, count(DISTINCT place) c FROM judged GROUP BY library)",
  """solve AS (SELECT library, pairs, n, c, 1.0::DOUBLE lo, n::DOUBLE * n / (2::DOUBLE * c * greatest(n - c, 1)) + 1 hi, 0 it FROM per_lib
  UNION ALL SELECT library, pairs, n, c,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN hi ELSE (lo + hi) / 2 END, it + 1
  FROM solve WHERE it < 60)""").replace("WITH contigs", "WITH RECURSIVE contigs", 1)

REMOVE_DUPLICATES = with_chain("""SELECT a.read_name, mate, a.contig_idx, pos FROM alignments a JOIN (
  SELECT read_name FROM (SELECT read_name, contig_idx, min(pos) lo, max(ref_end) hi FROM alignments GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY contig_idx, lo, hi ORDER BY read_name) = 1) b ON a.read_name = b.read_name""")

FIX_MATE_INFO = with_chain(f"""SELECT a.read_name, a.mate,
  CAST((a.flag & ~(8 | 32)) | (CASE WHEN b.flag & 4 <> 0 THEN 8 ELSE 0 END) | (CASE WHEN b.flag & 16 <> 0 THEN 32 ELSE 0 END) AS INT) AS flag,
  b.contig AS mate_contig, b.pos AS mate_pos,
  CAST(CASE WHEN (a.flag & 4) <> 0 OR (b.flag & 4) <> 0 THEN 0
    WHEN b.five > a.five THEN b.five - a.five + 1 WHEN b.five < a.five THEN b.five - a.five - 1
    WHEN a.mate = 1 THEN 1 ELSE -1 END AS INT) AS tlen
  FROM ends a JOIN ends b ON a.fid = b.fid AND a.mate = 3 - b.mate""",
  f"ends AS (SELECT fid, read_name, mate, flag, contig, pos, CASE WHEN mate = 2 THEN {_DIRTY_END} ELSE pos END five FROM dirty)")

REALIGN_TARGETS = with_chain("""SELECT contig_idx, min(s) AS start, max(e) AS "end" FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY contig_idx ORDER BY s ROWS UNBOUNDED PRECEDING) island FROM (
    SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY contig_idx ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      OR lag(s) OVER (PARTITION BY contig_idx ORDER BY s) IS NULL THEN 1 ELSE 0 END fresh
    FROM (SELECT contig_idx, s, max(e) e FROM padded GROUP BY ALL))) GROUP BY contig_idx, island""",
  """padded AS (SELECT contig_idx, CAST(greatest(pos - 10, 1) AS INT) s, CAST(pos + greatest(length(ref) - length(alt), 1) + 10 AS INT) e FROM known_indels
  UNION ALL SELECT contig_idx, CAST(greatest(pos0 + a - 10, 1) AS INT), CAST(pos0 + a + CASE WHEN deletes THEN 3 ELSE 1 END + 10 AS INT)
  FROM alignments WHERE gapped)""")


_ISLANDS = """islands AS (SELECT contig_idx, min(s) AS start, max(e) AS "end" FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY contig_idx ORDER BY s ROWS UNBOUNDED PRECEDING) island FROM (
    SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY contig_idx ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      OR lag(s) OVER (PARTITION BY contig_idx ORDER BY s) IS NULL THEN 1 ELSE 0 END fresh
    FROM (SELECT contig_idx, s, max(e) e FROM padded GROUP BY ALL))) GROUP BY contig_idx, island)"""

_COST = "list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN substr({0}, i, 1) <> substr({1}, i, 1) THEN q[i] ELSE 0 END))"
REALIGN_INDELS = with_chain("""SELECT c.read_name, c.mate, c.contig_idx, coalesce(m.new_pos, c.pos) AS pos,
  lead || coalesce(m.core, c.cigar) || trail AS cigar
  FROM core c LEFT JOIN moves m USING (read_name, mate)""",
  """given AS MATERIALIZED (SELECT a.read_name, a.mate, a.contig_idx, a.pos, a.cigar, s.seq, gapped, deletes, a.a, pos0,
    list_transform(range(50), lambda i: CASE WHEN CASE WHEN a.mate = 1 THEN i ELSE 49 - i END >= 46 THEN 6 + a.fid % 5 ELSE 28 + (a.fid + i) % 12 END) q,
    a.fid % 7 = 0 AND a.cigar = '50M' clipped FROM alignments a JOIN seqs s USING (fid, mate))""",
  """longs AS (SELECT contig_idx, seq cseq, w0 + 90 spot, CASE WHEN contig_idx % 3 = 1 THEN 'GATTACA' ELSE '' END ins
    FROM hosts WHERE contig_idx % 3 < 2)""",
  """core AS MATERIALIZED (
    SELECT read_name, mate, g.contig_idx, CAST(CASE WHEN clipped AND mate = 2 THEN pos + 5 ELSE pos END AS INT) pos,
      CASE WHEN clipped AND mate = 2 THEN '5S' ELSE '' END lead, CASE WHEN clipped AND mate = 1 THEN '5S' ELSE '' END trail,
      CASE WHEN clipped THEN '45M' ELSE cigar END cigar, CASE WHEN clipped THEN 45 ELSE 50 END n,
      CASE WHEN clipped AND mate = 2 THEN substr(g.seq, 6) WHEN clipped THEN substr(g.seq, 1, 45) ELSE g.seq END seq,
      CASE WHEN clipped AND mate = 2 THEN q[6:] WHEN clipped THEN q[:45] ELSE q END q,
      CASE WHEN gapped AND deletes THEN substr(c.seq, pos, a) || substr(c.seq, pos + a + 3, 50 - a)
        WHEN gapped THEN substr(c.seq, pos, a) || substr(g.seq, a + 1, 3) || substr(c.seq, pos + a, 47 - a)
        WHEN clipped AND mate = 2 THEN substr(c.seq, pos + 5, 45) WHEN clipped THEN substr(c.seq, pos, 45) ELSE substr(c.seq, pos, 50) END under,
      pos + 49 - CASE WHEN clipped AND mate = 1 THEN 5 ELSE 0 END + CASE WHEN gapped THEN CASE WHEN deletes THEN 3 ELSE -3 END ELSE 0 END e
    FROM given g JOIN contigs c USING (contig_idx)
    UNION ALL
    SELECT concat('x', contig_idx, '_', k), 1, contig_idx, CAST(spot - 19 - k AS INT), '', '', '50M', 50,
      substr(cseq, spot - 19 - k, 20 + k) || ins || substr(cseq, spot + 71, 30 - k - length(ins)), list_transform(range(50), lambda i: 30),
      substr(cseq, spot - 19 - k, 50), spot + 30 - k FROM longs CROSS JOIN range(8) r(k))""",
  """trims AS (SELECT *, list_max(list_filter(range(8), lambda t: t < length(alt) AND right(ref, t) = right(alt, t))) t
    FROM (SELECT contig_idx, spot, substr(cseq, spot, 71) ref, substr(cseq, spot, 1) || ins alt FROM longs))""",
  """heads AS (SELECT contig_idx, spot, left(ref, length(ref) - t) ref, left(alt, length(alt) - t) alt FROM trims)""",
  """shorts AS (SELECT *, list_max(list_filter(range(8), lambda h: h < length(alt) AND left(ref, h) = left(alt, h))) h FROM heads)""",
  """cands AS MATERIALIZED (
    SELECT contig_idx, pos spot, length(ref) - length(alt) gone, '' ins FROM known_indels WHERE length(ref) > length(alt)
    UNION SELECT contig_idx, pos, 0, substr(alt, 2) FROM known_indels WHERE length(ref) < length(alt)
    UNION SELECT contig_idx, spot + h - 1 + same, length(ref) - h - same, substr(alt, h + 1 + same) FROM (
      SELECT *, CASE WHEN substr(ref, h + 1, 1) = substr(alt, h + 1, 1) THEN 1 ELSE 0 END same FROM shorts)
    UNION SELECT contig_idx, pos0 + a, CASE WHEN deletes THEN 3 ELSE 0 END, CASE WHEN deletes THEN '' ELSE substr(seq, a + 1, 3) END
      FROM given WHERE gapped)""",
  """padded AS (SELECT contig_idx, CAST(greatest(spot - 10, 1) AS INT) s, CAST(spot + greatest(gone, 1) + 10 AS INT) e FROM cands)""",
  _ISLANDS,
  """pairs AS (SELECT c.*, t.start target, spot, gone, ins, kept, s.seq cseq, CASE WHEN kept = 0 THEN spot - c.pos + 1 ELSE n - length(ins) - (e - spot - gone) END head
    FROM core c JOIN cands d USING (contig_idx) JOIN islands t ON t.contig_idx = c.contig_idx AND spot BETWEEN t.start AND t."end"
      JOIN contigs s ON s.contig_idx = c.contig_idx CROSS JOIN (VALUES (0), (1)) k(kept)
    WHERE CASE WHEN kept = 0 THEN spot ELSE spot + gone + 1 END BETWEEN c.pos AND e)""",
  f"""scored AS MATERIALIZED (SELECT *, {_COST.format('seq', 'under')} - {_COST.format('seq', 'hap')} gain FROM (
    SELECT *, n - head - length(ins) tail, substr(cseq, spot - head + 1, head) || ins || substr(cseq, spot + gone + 1, n - head - length(ins)) hap
    FROM pairs WHERE head >= 1 AND n - head - length(ins) >= 1 AND spot - head + 1 >= 1) WHERE length(hap) = n)""",
  """gains AS MATERIALIZED (SELECT *, spot - head + 1 new_pos, concat(head, 'M', CASE WHEN gone > 0 THEN gone || 'D' ELSE '' END,
      CASE WHEN ins <> '' THEN length(ins) || 'I' ELSE '' END, tail, 'M') core FROM scored WHERE gain > 0
    QUALIFY row_number() OVER (PARTITION BY read_name, mate, contig_idx, target, spot, gone, ins ORDER BY gain DESC, kept) = 1)""",
  """chosen AS (SELECT * FROM (SELECT contig_idx, target, spot, gone, ins, sum(gain) total FROM gains GROUP BY ALL) WHERE total >= 50
    QUALIFY row_number() OVER (PARTITION BY contig_idx, target ORDER BY total DESC, spot, gone, ins) = 1)""",
  """moves AS (SELECT read_name, mate, CAST(new_pos AS INT) new_pos, core FROM gains JOIN chosen USING (contig_idx, target, spot, gone, ins)
    QUALIFY row_number() OVER (PARTITION BY read_name, mate ORDER BY gain DESC, new_pos, core) = 1)""")


def _bqsr(source: str, prefix: str) -> list[str]:
    return [
        f"""{prefix}ev AS (SELECT b.*, CASE WHEN k.pos IS NULL THEN 0 ELSE 1 END masked FROM (
          SELECT contig_idx, read_group, mate, q, rpos, base, ref_base, CAST(CASE WHEN mate = 1 THEN m + 1 ELSE -(m + 1) END AS INT) cycle,
            lag(mb) OVER (PARTITION BY fid, mate ORDER BY m) || mb context
          FROM (SELECT *, CASE WHEN mate = 1 THEN i ELSE 49 - i END m,
                  CASE WHEN mate = 1 THEN base ELSE translate(base, 'ACGT', 'TGCA') END mb FROM {source}) x) b
          LEFT JOIN known_snps k ON k.contig_idx = b.contig_idx AND k.pos = b.rpos)""",
        f"""{prefix}cells AS (SELECT read_group, q, cycle, context, count(*) n, CAST(sum(CASE WHEN base <> ref_base THEN 1 ELSE 0 END) AS BIGINT) e
          FROM {prefix}ev WHERE rpos IS NOT NULL AND masked = 0 AND q >= 6 GROUP BY ALL)""",
        f"""{prefix}tab AS (SELECT *, CAST(round(-10 * log10((errors + 1) / (observations + 2)::DOUBLE)) AS INT) empirical_q FROM (
          SELECT read_group, CAST(NULL AS INT) reported_q, 'read_group' covariate, '' "value", CAST(sum(n) AS BIGINT) observations, CAST(sum(e) AS BIGINT) errors FROM {prefix}cells GROUP BY ALL
          UNION ALL SELECT read_group, q, 'quality', '', CAST(sum(n) AS BIGINT), CAST(sum(e) AS BIGINT) FROM {prefix}cells GROUP BY ALL
          UNION ALL SELECT read_group, q, 'cycle', CAST(cycle AS VARCHAR), CAST(sum(n) AS BIGINT), CAST(sum(e) AS BIGINT) FROM {prefix}cells GROUP BY ALL
          UNION ALL SELECT read_group, q, 'context', context, CAST(sum(n) AS BIGINT), CAST(sum(e) AS BIGINT) FROM {prefix}cells
            WHERE context IS NOT NULL GROUP BY ALL))""",
    ]


_NEW_Q = """fresh AS (SELECT b.fid, b.mate, b.i, b.read_name, b.contig_idx, b.read_group, b.rpos, b.base, b.ref_base,
  CAST(CASE WHEN b.q < 6 OR qt.empirical_q IS NULL THEN b.q ELSE least(greatest(qt.empirical_q
    + coalesce(ct.empirical_q - qt.empirical_q, 0) + coalesce(xt.empirical_q - qt.empirical_q, 0), 1), 60) END AS INT) q
  FROM (SELECT *, CAST(CASE WHEN mate = 1 THEN m + 1 ELSE -(m + 1) END AS VARCHAR) cycle,
          lag(mb) OVER (PARTITION BY fid, mate ORDER BY m) || mb context
        FROM (SELECT *, CASE WHEN mate = 1 THEN i ELSE 49 - i END m,
                CASE WHEN mate = 1 THEN base ELSE translate(base, 'ACGT', 'TGCA') END mb FROM bases) x) b
  LEFT JOIN tab qt ON qt.covariate = 'quality' AND qt.read_group = b.read_group AND qt.reported_q = b.q
  LEFT JOIN tab ct ON ct.covariate = 'cycle' AND ct.read_group = b.read_group AND ct.reported_q = b.q AND ct."value" = b.cycle
  LEFT JOIN tab xt ON xt.covariate = 'context' AND xt.read_group = b.read_group AND xt.reported_q = b.q AND xt."value" = b.context)"""

BQSR_TABLE = with_chain("SELECT * FROM tab", *_bqsr("bases", ""))
BQSR_APPLY = with_chain("""SELECT any_value(read_name) AS read_name, mate, string_agg(chr(q + 33), '' ORDER BY i) AS qual
  FROM fresh GROUP BY fid, mate""", *_bqsr("bases", ""), _NEW_Q)
BQSR_POST_TABLE = with_chain("""SELECT coalesce(a.read_group, b.read_group) AS read_group, coalesce(a.q, b.q) AS reported_q,
  coalesce(a.covariate, b.covariate) AS covariate, coalesce(a."value", b."value") AS "value",
  a.observations AS observations_before, a.errors AS errors_before, a.empirical_q AS empirical_q_before,
  b.observations AS observations_after, b.errors AS errors_after, b.empirical_q AS empirical_q_after
  FROM (SELECT *, coalesce(reported_q, -1) q FROM tab) a FULL JOIN (SELECT *, coalesce(reported_q, -1) q FROM posttab) b
  ON a.read_group = b.read_group AND a.q = b.q AND a.covariate = b.covariate AND a."value" = b."value" """,
  *_bqsr("bases", ""), _NEW_Q, *_bqsr("fresh", "post"))

PILEUP = with_chain("""SELECT contig_idx, pos, ref_base, base, count(*) AS n, CAST(sum(q) AS BIGINT) AS q_sum
  FROM pile GROUP BY ALL""", PILE, PILE10)

DOWNSAMPLE_COVERAGE = with_chain("""SELECT contig_idx, pos, count(*) AS n, min(read_name) AS first_name, max(read_name) AS last_name,
  CAST(sum(CAST(substr(read_name, 2) AS BIGINT)) AS BIGINT) AS name_sum FROM (
  SELECT * FROM pile QUALIFY row_number() OVER (PARTITION BY contig_idx, pos ORDER BY md5(read_name), read_name, mate) <= 5)
  GROUP BY ALL""", PILE, PILE10)

RESTRICT_TO_INTERVALS = with_chain("""SELECT read_name, mate, contig_idx, pos, cigar FROM alignments a
  WHERE EXISTS (SELECT 1 FROM targets t WHERE t.contig_idx = a.contig_idx AND a.pos <= t.end_pos AND a.ref_end >= t.start_pos)""")

CALL_SNPS = with_chain("SELECT * FROM snps", PILE, PILE10, *_sites(2))
CALL_INDELS = _recursive(with_chain("SELECT * FROM indels", *_indels(2)))
CALL_BOTH = _recursive(with_chain("SELECT * FROM snps UNION ALL SELECT * FROM indels", PILE, PILE10, *_sites(2), *_indels(2)))
EMIT_MODE = with_chain("SELECT * FROM sites WHERE qual >= 30 OR ref_qual >= 30", PILE, PILE10, *_sites(2))
CALL_GENERAL_PLOIDY = _recursive(with_chain("SELECT * FROM snps UNION ALL SELECT * FROM indels", PILE, PILE10, *_sites(4), *_indels(4)))

LEFT_NORMALIZE_INDELS = _recursive(with_chain("""SELECT contig_idx, contig, pos, op, CAST(length(t) AS INT) AS len, CASE WHEN op = 'I' THEN t ELSE '' END AS ins,
    CAST(sum(ad) AS BIGINT) AS events FROM normal GROUP BY ALL""",
  """events AS (SELECT contig_idx, contig, pos, op, substr(seq, pos + 1, CASE WHEN op = 'D' THEN 1 + pos % 3 ELSE 1 + pos % 4 END) t, 1 ad
       FROM (SELECT contig_idx, contig, seq, unnest(range(97, contig_len - 7, 97)) pos FROM contigs WHERE contig_len >= 110) e
       CROSS JOIN (VALUES ('D'), ('I')) o(op))""", *_SHIFTED))

_T2 = [_term(k, 2, "q") for k in range(3)]
CALL_SNP_ALLELES = with_chain("""SELECT contig_idx, contig, pos, ref_base AS "ref",
    array_to_string(list_transform(alts, lambda k: ls[k + 1]), ',') AS alt, qual,
    concat(coalesce(list_position(alts, g.i), 0), '/', coalesce(list_position(alts, g.j), 0)) AS gt, dp,
    concat_ws(',', ns[1], array_to_string(list_transform(alts, lambda k: ns[k + 1]), ',')) AS ad
  FROM (SELECT *, CASE WHEN g.i = 0 OR g.i = g.j THEN [g.j] ELSE [g.i, g.j] END alts FROM best) JOIN sites USING (contig_idx, pos) WHERE g.j > 0 AND qual >= 30""",
  PILE, PILE10, """changed AS (SELECT * REPLACE (CASE WHEN (pos * 31 + contig_idx * 17) % 211 = 0 AND base <> '*' AND CAST(substr(read_name, 2) AS BIGINT) % 4 < 2
      THEN translate(ref_base, 'ACGT', 'CGTA') ELSE base END AS base) FROM pile)""",
  f"""letters AS (SELECT contig_idx, contig, pos, ref_base, base, count(*) n, {', '.join(f"CAST(sum({t}) AS BIGINT) s{k}" for k, t in enumerate(_T2))}
      FROM changed WHERE q >= 10 AND base IN ('A', 'C', 'G', 'T') GROUP BY ALL)""",
  """loci AS (SELECT contig_idx, contig, pos, ref_base, sum(n)::BIGINT dp FROM letters WHERE ref_base IN ('A', 'C', 'G', 'T')
      GROUP BY ALL HAVING sum(n) FILTER (base <> ref_base) > 0)""",
  """cells AS (SELECT o.*, coalesce(n, 0) n, coalesce(s0, 0) s0, coalesce(s1, 0) s1, coalesce(s2, 0) s2 FROM (
      SELECT l.*, v.base, row_number() OVER (PARTITION BY contig_idx, pos ORDER BY v.base <> ref_base, v.base) - 1 k
      FROM loci l CROSS JOIN (VALUES ('A'), ('C'), ('G'), ('T')) v(base)) o LEFT JOIN letters x USING (contig_idx, pos, base))""",
  """sites AS (SELECT contig_idx, contig, pos, ref_base, dp, list(n ORDER BY k) ns, list(base ORDER BY k) ls, list(s0 ORDER BY k) a0, list(s1 ORDER BY k) a1, list(s2 ORDER BY k) a2
      FROM cells GROUP BY ALL)""",
  f"""pairs AS (SELECT contig_idx, pos, i, j, (CASE WHEN i = j THEN a0[i + 1] ELSE a1[i + 1] + a1[j + 1] END
      + list_sum(a2) - a2[i + 1] - CASE WHEN i = j THEN 0 ELSE a2[j + 1] END) / 1000000.0::DOUBLE + {_pair_model(SNP_THETA)} p
      FROM sites CROSS JOIN range(4) x(i) JOIN range(4) y(j) ON j >= i)""", _BEST_PAIR)

_TI = [_term(k, 2, str(INDEL_QUALITY)) for k in range(3)]
CALL_INDEL_ALLELES = _recursive(with_chain("""SELECT contig_idx, contig, pos, whole AS "ref",
    array_to_string(list_transform(alts, lambda k: a[k].alt || substr(whole, length(a[k].ref) + 1)), ',') AS alt, qual,
    concat(coalesce(list_position(alts, g.i), 0), '/', coalesce(list_position(alts, g.j), 0)) AS gt, dp,
    concat_ws(',', ns[1], array_to_string(list_transform(alts, lambda k: ns[k + 1]), ',')) AS ad
  FROM (SELECT *, list_reduce(list_transform(alts, lambda k: a[k].ref), lambda x, y: CASE WHEN length(y) > length(x) THEN y ELSE x END) whole FROM (
    SELECT *, CASE WHEN g.i = 0 OR g.i = g.j THEN [g.j] ELSE [g.i, g.j] END alts FROM best JOIN sites USING (contig_idx, pos) WHERE g.j > 0 AND qual >= 30))""",
  """ins_seq AS (SELECT fid, mate, string_agg(base, '' ORDER BY i) ins FROM bases1 WHERE rpos IS NULL GROUP BY ALL)""",
  """changed AS (SELECT * REPLACE (ref_end + CASE WHEN gapped AND fid % 4 = 1 THEN 1 ELSE 0 END AS ref_end) FROM alignments)""",
  """events AS (SELECT g.contig_idx, g.contig, g.pos0 + g.a pos, CASE WHEN deletes THEN 'D' ELSE 'I' END op,
      CASE WHEN deletes THEN substr(c.seq, g.pos0 + g.a + 1, CASE WHEN g.fid % 4 = 1 THEN 4 ELSE 3 END) WHEN g.fid % 4 = 1 THEN left(s.ins, 2) ELSE s.ins END t, count(*) ad
      FROM alignments g JOIN contigs c ON c.contig_idx = g.contig_idx LEFT JOIN ins_seq s ON s.fid = g.fid AND s.mate = g.mate WHERE gapped GROUP BY ALL)""",
  *_SHIFTED,
  """seen AS (SELECT contig_idx, contig, pos, CASE WHEN op = 'D' THEN b || t ELSE b END "ref", CASE WHEN op = 'D' THEN b ELSE b || t END alt,
      CAST(sum(ad) AS BIGINT) ad FROM normal GROUP BY ALL)""",
  """depths AS (SELECT s.contig_idx, s.pos, greatest(any_value(s.n), count(b.fid)) dp FROM (SELECT contig_idx, pos, sum(ad)::BIGINT n FROM seen GROUP BY ALL) s
      LEFT JOIN changed b ON b.contig_idx = s.contig_idx AND b.pos <= s.pos AND b.ref_end > s.pos GROUP BY ALL)""",
  """sites AS (SELECT contig_idx, contig, pos, dp, list({'ref': "ref", 'alt': alt} ORDER BY ad DESC, "ref", alt) FILTER (ad >= dp * 0.1) a,
      [dp - sum(ad)::BIGINT] || list(ad ORDER BY ad DESC, "ref", alt) FILTER (ad >= dp * 0.1) ns
      FROM seen JOIN depths USING (contig_idx, pos) GROUP BY contig_idx, contig, pos, dp HAVING count(*) FILTER (ad >= dp * 0.1) > 0)""",
  f"""pairs AS (SELECT contig_idx, pos, i, j, (CASE WHEN i = j THEN ns[i + 1] * {_TI[0]} + (dp - ns[i + 1]) * {_TI[2]}
      ELSE (ns[i + 1] + ns[j + 1]) * {_TI[1]} + (dp - ns[i + 1] - ns[j + 1]) * {_TI[2]} END) / 1000000.0::DOUBLE + {_pair_model(INDEL_THETA)} p
      FROM (SELECT *, unnest(range(len(ns))) i FROM sites) s JOIN range(100) y(j) ON j >= i AND j < len(ns))""", _BEST_PAIR))

ANNOTATE_KNOWN_IDS = with_chain("""SELECT s.*, coalesce(k.id, '.') AS id FROM snps s LEFT JOIN known_snps k
  ON k.contig_idx = s.contig_idx AND k.pos = s.pos AND k.ref = s.ref AND k.alt = s.alt""", PILE, PILE10, *_sites(2))

ANN_ALLELE_BALANCE = with_chain("""SELECT *, CASE WHEN gt = '0/1' THEN round((dp - ad) / dp::DOUBLE, 6) END AS allele_balance
  FROM snps""", PILE, PILE10, *_sites(2))

ANN_DEPTH = with_chain("""SELECT s.contig_idx, s.pos, ref, alt, count(*) AS depth FROM snps s
  JOIN pile_all p ON p.contig_idx = s.contig_idx AND p.pos = s.pos GROUP BY ALL""", PILE, PILE10, *_sites(2))

ANN_SPANNING_DELETIONS = with_chain("""SELECT s.contig_idx, s.pos, ref, alt,
  round(count(*) FILTER (p.base = '*') / count(*)::DOUBLE, 6) AS spanning_deletions FROM snps s
  JOIN pile_all p ON p.contig_idx = s.contig_idx AND p.pos = s.pos GROUP BY ALL""", PILE, PILE10, *_sites(2))

CALLER_METRICS = with_chain("""SELECT (SELECT count(*) FROM (SELECT DISTINCT contig_idx, pos FROM pile_all)) AS visited,
  count(*) AS callable, count(*) FILTER (qual >= 30 OR ref_qual >= 30) AS confident, count(*) FILTER (qual >= 30) AS variants
  FROM sites""", PILE, PILE10, *_sites(2))

CONTIG_READ_COUNTS = with_chain("""SELECT c.contig_idx, c.contig, c.contig_len, count(*) FILTER (d.flag & 4 = 0) AS mapped,
  count(*) FILTER (d.flag & 4 <> 0) AS unmapped FROM contigs c LEFT JOIN dirty d ON d.contig_idx = c.contig_idx GROUP BY ALL""")

HS_METRICS = with_chain("""SELECT t.bases, on_bait, near_bait, t.bases - on_bait - near_bait AS off_bait, target_length, bait_length,
  round(tb / target_length::DOUBLE, 6) AS mean_target_coverage,
  round(c1 / target_length::DOUBLE, 6) AS share_at_1x, round(c2 / target_length::DOUBLE, 6) AS share_at_2x,
  round(c10 / target_length::DOUBLE, 6) AS share_at_10x, round(c20 / target_length::DOUBLE, 6) AS share_at_20x,
  round(c30 / target_length::DOUBLE, 6) AS share_at_30x,
  round((on_bait / t.bases::DOUBLE) / (bait_length / (SELECT sum(contig_len) FROM contigs)::DOUBLE), 4) AS fold_enrichment
  FROM (SELECT CAST(sum(n) AS BIGINT) bases, CAST(coalesce(sum(n) FILTER (b), 0) AS BIGINT) on_bait,
          CAST(coalesce(sum(n) FILTER (w AND NOT b), 0) AS BIGINT) near_bait
        FROM (SELECT d.n, bp.pos IS NOT NULL b, wp.pos IS NOT NULL w FROM depth d
              LEFT JOIN bait_pos bp ON bp.contig_idx = d.contig_idx AND bp.pos = d.pos
              LEFT JOIN wide_pos wp ON wp.contig_idx = d.contig_idx AND wp.pos = d.pos)) t
  CROSS JOIN (SELECT count(*) target_length, CAST(sum(coalesce(n, 0)) AS BIGINT) tb, count(*) FILTER (n >= 1) c1, count(*) FILTER (n >= 2) c2,
          count(*) FILTER (n >= 10) c10, count(*) FILTER (n >= 20) c20, count(*) FILTER (n >= 30) c30
        FROM target_pos p LEFT JOIN depth d ON d.contig_idx = p.contig_idx AND d.pos = p.pos) u
  CROSS JOIN (SELECT count(*) bait_length FROM bait_pos) v""",
  "depth AS (SELECT contig_idx, rpos pos, count(*) n FROM bases1 WHERE rpos IS NOT NULL GROUP BY ALL)",
  "target_pos AS (SELECT DISTINCT contig_idx, unnest(range(start_pos, end_pos + 1)) pos FROM targets)",
  "bait_pos AS (SELECT DISTINCT contig_idx, unnest(range(start_pos, end_pos + 1)) pos FROM baits)",
  "wide_pos AS (SELECT DISTINCT contig_idx, unnest(range(greatest(start_pos - 250, 1), end_pos + 251)) pos FROM baits)")

ALIGNMENT_SUMMARY = with_chain("""SELECT CASE WHEN r.mate IS NULL THEN 'pair' WHEN r.mate = 1 THEN 'first' ELSE 'second' END AS category,
  reads, reads AS aligned, round(wrong / nb::DOUBLE, 8) AS mismatch_rate, round(indels / nb::DOUBLE, 8) AS indel_rate,
  50.0::DOUBLE AS mean_read_length, round(fwd / reads::DOUBLE, 6) AS strand_balance
  FROM (SELECT mate, count(*) reads, count(*) FILTER (gapped) indels, count(*) FILTER (flag & 16 = 0) fwd FROM alignments GROUP BY ROLLUP (mate)) r
  JOIN (SELECT mate, count(*) nb, count(*) FILTER (base <> ref_base) wrong FROM bases WHERE rpos IS NOT NULL GROUP BY ROLLUP (mate)) b
  ON r.mate IS NOT DISTINCT FROM b.mate""")

_GC = [
    """gc_at AS (SELECT * FROM (SELECT contig_idx, rpos, CAST(sum(CASE WHEN ref_base IN ('C', 'G') THEN 1 ELSE 0 END) OVER w AS INT) gc,
         count(*) OVER w n FROM ref_bases WINDOW w AS (PARTITION BY contig_idx ORDER BY rpos ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING)) WHERE n = 100)""",
    """gc_reads AS (SELECT g.gc, count(*) read_starts, sum(qs) qs, count(*) * 50 len FROM
         (SELECT a.contig_idx, CASE WHEN a.mate = 1 THEN pos ELSE ref_end - 99 END p, qs FROM alignments a
          JOIN (SELECT fid, mate, sum(q) qs FROM bases1 GROUP BY ALL) s ON s.fid = a.fid AND s.mate = a.mate) r
         JOIN gc_at g ON g.contig_idx = r.contig_idx AND g.rpos = r.p GROUP BY g.gc)""",
    """gc_table AS (SELECT w.gc, windows, coalesce(read_starts, 0) read_starts,
         round((coalesce(read_starts, 0) / windows::DOUBLE) / (sum(coalesce(read_starts, 0)) OVER ()::DOUBLE / sum(windows) OVER ()::DOUBLE), 6) normalized_coverage,
         round(qs / len::DOUBLE, 6) mean_quality
         FROM (SELECT gc, count(*) windows FROM gc_at GROUP BY gc) w LEFT JOIN gc_reads r ON r.gc = w.gc)""",
]
GC_BIAS = with_chain("SELECT * FROM gc_table", *_GC)
GC_BIAS_SUMMARY = with_chain("""SELECT CAST(sum(windows) AS BIGINT) AS windows, CAST(sum(read_starts) AS BIGINT) AS read_starts,
  round(sum(CASE WHEN gc <= 50 THEN lost ELSE 0 END), 4) AS at_dropout, round(sum(CASE WHEN gc > 50 THEN lost ELSE 0 END), 4) AS gc_dropout
  FROM (SELECT *, greatest(windows * 100 / sum(windows) OVER ()::DOUBLE - read_starts * 100 / sum(read_starts) OVER ()::DOUBLE, 0) lost FROM gc_table)""", *_GC)

QUALITY_BY_CYCLE = with_chain("""SELECT CAST(i + 1 + CASE WHEN mate = 2 THEN 50 ELSE 0 END AS INT) AS cycle, count(*) AS bases,
  round(sum(q) / count(*)::DOUBLE, 6) AS mean_quality FROM raw_bases GROUP BY ALL""")
QUALITY_DISTRIBUTION = with_chain("SELECT q AS quality, count(*) AS bases FROM bases1 GROUP BY q")

INSERT_SIZE_METRICS = with_chain("""SELECT 'FR' AS orientation, median(tlen) AS median_size, count(*) AS pairs, mad(tlen)::DOUBLE AS mad,
  round(avg(tlen), 4) AS mean_size, round(stddev_samp(tlen), 4) AS sd_size, min(tlen) AS min_size, max(tlen) AS max_size
  FROM alignments WHERE mate = 1""")
INSERT_SIZE_HISTOGRAM = with_chain("SELECT 'FR' AS orientation, tlen AS size, count(*) AS pairs FROM alignments WHERE mate = 1 GROUP BY tlen")

LIBRARY_COMPLEXITY = with_chain("""SELECT set_size, sets, CASE WHEN c < n THEN CAST(round(c * (lo + hi) / 2) AS BIGINT) END AS unique_estimate
  FROM hist CROSS JOIN solve WHERE it = 60""",
  """heads AS (SELECT l.l, r.r, count(*) set_size FROM (SELECT fid, seq l FROM raw_reads WHERE mate = 1) l
  JOIN (SELECT fid, seq r FROM raw_reads WHERE mate = 2) r ON l.fid = r.fid GROUP BY ALL)""",
  "hist AS (SELECT set_size, count(*) sets FROM heads GROUP BY set_size)",
  "tot AS (SELECT CAST(sum(set_size * sets) AS BIGINT) n, CAST(sum(sets) AS BIGINT) c FROM hist)",
  """solve AS (SELECT n, c, 1.0::DOUBLE lo, n::DOUBLE * n / (2::DOUBLE * c * greatest(n - c, 1)) + 1 hi, 0 it FROM tot
  UNION ALL SELECT n, c,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN hi ELSE (lo + hi) / 2 END, it + 1
  FROM solve WHERE it < 60)""").replace("WITH contigs", "WITH RECURSIVE contigs", 1)

MOLECULE_COMPLEXITY = with_chain("""SELECT set_size, sets, CASE WHEN c < n THEN CAST(round(c * (lo + hi) / 2) AS BIGINT) END AS unique_estimate
  FROM hist CROSS JOIN solve WHERE it = 60""",
  """planted AS (SELECT fid, mate, CASE WHEN fid % 4 > 0 THEN seq
    WHEN mate = 1 THEN concat(substr(repeat('ACGTA', 10), 1, fid % 50), substr('ACGT', fid // 50 % 4 + 1, 1), substr(repeat('ACGTA', 10), fid % 50 + 2))
    WHEN fid % 12 = 0 THEN concat(substr(repeat('GATTC', 10), 1, fid * 7 % 50), 'T', substr(repeat('GATTC', 10), fid * 7 % 50 + 2))
    ELSE repeat('GATTC', 10) END seq FROM raw_reads)""",
  """heads AS (SELECT min(l.fid) id, l, r, count(*) n FROM (SELECT fid, seq l FROM planted WHERE mate = 1) l
  JOIN (SELECT fid, seq r FROM planted WHERE mate = 2) r ON l.fid = r.fid GROUP BY l, r)""",
  """linked AS (SELECT a.id a, b.id b FROM heads a JOIN heads b ON a.l = b.l AND length(a.r) = length(b.r) WHERE hamming(a.r, b.r) <= 1
  UNION SELECT a.id, b.id FROM heads a JOIN heads b ON a.r = b.r AND length(a.l) = length(b.l) WHERE hamming(a.l, b.l) <= 1)""",
  "reached AS (SELECT a, b FROM linked UNION SELECT r.a, e.b FROM reached r JOIN linked e ON e.a = r.b)",
  "sizes AS (SELECT m, sum(n) set_size FROM heads JOIN (SELECT a, min(b) m FROM reached GROUP BY a) k ON k.a = id GROUP BY m)",
  "hist AS (SELECT CAST(set_size AS BIGINT) set_size, count(*) sets FROM sizes GROUP BY set_size)",
  "tot AS (SELECT CAST(sum(set_size * sets) AS BIGINT) n, CAST(sum(sets) AS BIGINT) c FROM hist)",
  """solve AS (SELECT n, c, 1.0::DOUBLE lo, n::DOUBLE * n / (2::DOUBLE * c * greatest(n - c, 1)) + 1 hi, 0 it FROM tot
  UNION ALL SELECT n, c,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN (lo + hi) / 2 * (1 - exp(-n::DOUBLE / ((lo + hi) / 2 * c))) < 1 THEN hi ELSE (lo + hi) / 2 END, it + 1
  FROM solve WHERE it < 60)""").replace("WITH contigs", "WITH RECURSIVE contigs", 1)

_DEPTH = [
    "cover AS (SELECT contig_idx, rpos pos, count(*) n FROM bases1 WHERE rpos IS NOT NULL GROUP BY ALL)",
    "spots AS (SELECT DISTINCT contig_idx, CAST(unnest(range(start_pos, end_pos + 1)) AS INT) pos FROM targets)",
    "depths AS (SELECT s.contig_idx, s.pos, coalesce(n, 0) AS depth FROM spots s LEFT JOIN cover c ON c.contig_idx = s.contig_idx AND c.pos = s.pos)",
]
DEPTH_OF_COVERAGE = with_chain("SELECT * FROM depths", *_DEPTH)
DEPTH_SUMMARY = with_chain("""SELECT count(*) AS positions, round(sum(depth) / count(*)::DOUBLE, 6) AS mean_depth,
  round(count(*) FILTER (depth >= 1) / count(*)::DOUBLE, 6) AS share_at_1x, round(count(*) FILTER (depth >= 2) / count(*)::DOUBLE, 6) AS share_at_2x,
  round(count(*) FILTER (depth >= 10) / count(*)::DOUBLE, 6) AS share_at_10x, round(count(*) FILTER (depth >= 20) / count(*)::DOUBLE, 6) AS share_at_20x,
  round(count(*) FILTER (depth >= 30) / count(*)::DOUBLE, 6) AS share_at_30x FROM depths""", *_DEPTH)

REALIGN_TARGETS_CLUSTERS = with_chain("""SELECT contig_idx, start, "end" FROM islands""",
  """wrong AS (SELECT contig_idx, rpos pos, sum(q)::BIGINT m FROM bases WHERE rpos IS NOT NULL AND base <> ref_base GROUP BY ALL)""",
  """depths AS (SELECT contig_idx, rpos pos, count(*) depth FROM bases WHERE rpos IS NOT NULL GROUP BY ALL)""",
  """clusters AS (SELECT contig_idx, f, pos FROM (
      SELECT *, sum(m) OVER w total, count(*) OVER w loci, min(pos) OVER w f FROM wrong
      WINDOW w AS (PARTITION BY contig_idx ORDER BY pos RANGE BETWEEN 9 PRECEDING AND CURRENT ROW)) JOIN depths USING (contig_idx, pos)
      WHERE loci > 1 AND total >= 8 * depth)""",
  """padded AS (SELECT contig_idx, CAST(greatest(pos - 10, 1) AS INT) s, CAST(pos + greatest(length(ref) - length(alt), 1) + 10 AS INT) e FROM known_indels
      UNION ALL SELECT contig_idx, CAST(greatest(pos0 + a - 10, 1) AS INT), CAST(pos0 + a + CASE WHEN deletes THEN 3 ELSE 1 END + 10 AS INT)
      FROM alignments WHERE gapped
      UNION ALL SELECT contig_idx, CAST(greatest(f - 10, 1) AS INT), CAST(pos + 10 AS INT) FROM clusters)""", _ISLANDS)

REFERENCE_RUNS = with_chain("""SELECT contig_idx, contig, min(rpos) AS start, max(rpos) AS "end", state FROM (
    SELECT *, rpos - row_number() OVER (PARTITION BY contig_idx, state ORDER BY rpos) run FROM (
      SELECT r.contig_idx, r.contig, r.rpos, CASE WHEN s.pos IS NULL THEN 'none' WHEN qual >= 30 THEN 'variant' WHEN ref_qual >= 30 THEN 'reference' ELSE 'unsure' END state
      FROM ref_bases r LEFT JOIN sites s ON s.contig_idx = r.contig_idx AND s.pos = r.rpos)) GROUP BY contig_idx, contig, state, run""",
  PILE, PILE10, *_sites(2))

FIND_PATTERNS = with_chain("""SELECT p.contig_idx AS pattern_id, r.contig_idx, r.contig, r.rpos AS pos
  FROM patterns p JOIN (SELECT contig_idx, contig, rpos, substr(ref_seq, k, 47) AS around FROM spots) r ON p.word = left(r.around, 8) AND starts_with(r.around, p.pattern)""",
  """patterns AS (SELECT contig_idx, pattern, left(pattern, 8) word FROM (
      SELECT contig_idx, substr(seq, 1 + contig_idx % 50, 8 + contig_idx % 40) pattern FROM contigs) WHERE length(pattern) >= 8
      UNION ALL SELECT contig_idx, NULL, NULL FROM contigs WHERE false)""",
  """runs AS (SELECT contig_idx, contig, b * 100 first, substr(seq, b * 100 + 1, 147) ref_seq FROM (
      SELECT *, unnest(range(0, (contig_len + 99) // 100)) b FROM contigs))""",
  """spots AS (SELECT contig_idx, contig, CAST(first + k AS INT) rpos, ref_seq, k FROM (SELECT *, unnest(range(1, least(100, length(ref_seq)) + 1)) k FROM runs))""")

_P = [f"power(10.0, (l{k} - greatest(l0, l1, l2)) / 1000000.0::DOUBLE)" for k in range(3)]
_T3 = [_term(k, 2, "q") for k in range(3)]
#: Every combination of genotypes of the samples of a site, one by one.
CALL_JOINT = _recursive(with_chain("""SELECT contig_idx, contig, pos, ref_base AS "ref", alt, round(q * 10, 2) AS qual, ac, CAST(2 * n AS INT) AS an, dp
  FROM judged WHERE q * 10 >= 30""",
  PILE, PILE10,
  f"""letters AS (SELECT contig_idx, contig, pos, ref_base, CAST(substr(read_name, 2) AS BIGINT) % 4 s, base, count(*) n, {', '.join(f"CAST(sum({t}) AS BIGINT) s{k}" for k, t in enumerate(_T3))}
      FROM pile WHERE q >= 10 AND base IN ('A', 'C', 'G', 'T') AND ref_base IN ('A', 'C', 'G', 'T') GROUP BY ALL)""",
  """chosen AS (SELECT contig_idx, pos, base alt FROM (SELECT contig_idx, pos, base, sum(n) n FROM letters WHERE base <> ref_base GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY contig_idx, pos ORDER BY n DESC, base) = 1)""",
  """persons AS (SELECT contig_idx, contig, pos, ref_base, alt, s, sum(n) FILTER (base = ref_base OR base = alt)::BIGINT dp,
      coalesce(sum(s0) FILTER (base = ref_base), 0) + coalesce(sum(s2) FILTER (base = alt), 0) l0,
      coalesce(sum(s1) FILTER (base = ref_base), 0) + coalesce(sum(s1) FILTER (base = alt), 0) l1,
      coalesce(sum(s2) FILTER (base = ref_base), 0) + coalesce(sum(s0) FILTER (base = alt), 0) l2
      FROM letters JOIN chosen USING (contig_idx, pos) GROUP BY ALL)""",
  f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY contig_idx, pos ORDER BY s) r, count(*) OVER (PARTITION BY contig_idx, pos) n,
      {_P[0]} p0, {_P[1]} p1, {_P[2]} p2 FROM persons WHERE dp > 0)""",
  """combos(contig_idx, pos, r, n, k, p) AS (
      SELECT contig_idx, pos, 0, any_value(n), 0, 1.0::DOUBLE FROM numbered GROUP BY contig_idx, pos
      UNION ALL SELECT c.contig_idx, c.pos, c.r + 1, c.n, c.k + g, c.p * CASE g WHEN 0 THEN p0 WHEN 1 THEN 2 * p1 ELSE p2 END
      FROM combos c JOIN numbered x ON x.contig_idx = c.contig_idx AND x.pos = c.pos AND x.r = c.r + 1 CROSS JOIN range(3) v(g))""",
  """totals AS (SELECT contig_idx, pos, n, k, sum(p) z FROM combos WHERE r = n GROUP BY ALL)""",
  f"""posts AS (SELECT contig_idx, pos, n, k, log10(z) - log10(factorial(CAST(2 * n AS INT)) / (factorial(CAST(k AS INT)) * factorial(CAST(2 * n - k AS INT)))::DOUBLE)
      + CASE WHEN k = 0 THEN log10(1 - list_sum(list_transform(range(1, 2 * n + 1), lambda i: {SNP_THETA} / i::DOUBLE))) ELSE log10({SNP_THETA}::DOUBLE) - log10(k) END p
      FROM totals WHERE z > 0)""",
  """judged AS (SELECT contig_idx, contig, pos, ref_base, alt, n, ac, dp, m + log10(t) - none q FROM (
      SELECT contig_idx, pos, n, max(p) m, CAST(arg_max(k, (p, -k)) AS INT) ac, max(p) FILTER (k = 0) none, list_sum(list_transform(list(p), lambda x: pow(10.0, x - list_max(list(p))))) t
      FROM posts GROUP BY ALL) JOIN (SELECT contig_idx, contig, pos, ref_base, alt, sum(dp)::BIGINT dp FROM numbered GROUP BY ALL) USING (contig_idx, pos))"""))

RESCUE_MATES = with_chain("""SELECT read_name, 2 AS mate, '-' AS strand, contig_idx, CAST(place AS INT) AS pos, nm, '50M' AS cigar, 1::BIGINT AS n_loci FROM placed
  QUALIFY row_number() OVER (PARTITION BY read_name ORDER BY nm, abs(place - expected), place) = 1""",
  """lost AS (SELECT b.read_name, b.contig_idx, a.pos + 120 expected,
      left(s.seq, 9) || translate(s.seq[10], 'ACGT', 'CGTA') || substr(s.seq, 11, 15) || translate(s.seq[26], 'ACGT', 'CGTA')
        || substr(s.seq, 27, 15) || translate(s.seq[42], 'ACGT', 'CGTA') || substr(s.seq, 43, 8) seq
      FROM alignments b JOIN alignments a ON a.fid = b.fid AND a.mate = 1 AND a.cigar = '50M' JOIN seqs s ON s.fid = b.fid AND s.mate = 2
      WHERE b.mate = 2 AND b.cigar = '50M' AND b.fid % 10 = 0)""",
  """tried AS (SELECT l.*, place, substr(c.seq, place, 50) ref FROM (SELECT *, unnest(range(greatest(expected - 40, 1), expected + 41)) place FROM lost) l
      JOIN contigs c USING (contig_idx) WHERE place + 49 <= c.contig_len)""",
  """placed AS (SELECT * FROM (SELECT *, CAST(len(list_filter(range(1, 51), lambda i: seq[i] <> ref[i])) AS INT) nm FROM tried) WHERE nm <= 6)""")
