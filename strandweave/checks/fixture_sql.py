"""The same derivation as ``fixtures`` as common table expressions in plain SQL."""

CHAIN = """
WITH contigs AS (
  SELECT CAST(doc_id AS INT) contig_idx, concat('chr', CAST(doc_id AS VARCHAR)) contig, seq,
         CAST(length(seq) AS INT) contig_len
  FROM (SELECT doc_id, array_to_string(list_transform(string_split(letters, ''),
               lambda c: substr('ACGT', CAST(unicode(c) % 4 + 1 AS BIGINT), 1)), '') seq
        FROM (SELECT doc_id, regexp_replace(text, '[^\\p{L}]', '', 'g') letters FROM documents) l WHERE letters <> '') t
  WHERE length(seq) > 0),
ref_bases AS (
  SELECT contig_idx, contig, contig_len, unnest(string_split(seq, '')) ref_base,
         CAST(unnest(range(1, contig_len + 1)) AS INT) rpos FROM contigs),
hosts AS (
  SELECT *, CAST(contig_idx * 37 % (contig_len - 290) AS INT) w0,
         CAST(contig_idx * 37 % (contig_len - 290) + 40 AS INT) anchor,
         row_number() OVER (ORDER BY contig_idx) - 1 host_no
  FROM contigs WHERE contig_len >= 300),
frag AS (
  SELECT o_orderkey fid, h.contig_idx, contig, contig_len, anchor,
         CAST(CASE WHEN o_orderkey % 8 <> 0 THEN w0 + (x % 20) * 3 ELSE x % (contig_len - 260) END AS INT) fstart,
         CAST(150 + (o_custkey % 10) * 5 AS INT) isize, CAST(o_orderkey % 2 AS INT) hap, seq
  FROM (SELECT *, o_orderkey * 7919 + o_custkey * 31 x FROM orders) o JOIN hosts h
    ON h.host_no = (o_orderkey * 13 + o_custkey * 7) % (SELECT count(*) FROM hosts)),
frag_win AS (SELECT * EXCLUDE (seq), substr(seq, fstart + 1, isize + 3) win FROM frag),
reads0 AS (
  SELECT f.*, CAST(m AS INT) mate, CAST(CASE WHEN m = 1 THEN fstart ELSE fstart + isize - 50 END AS INT) pos0
  FROM frag_win f CROSS JOIN (VALUES (1), (2)) v(m)),
reads1 AS (
  SELECT *, anchor - pos0 a, pos0 - fstart off, contig_idx % 2 = 0 deletes,
         hap = 1 AND anchor - pos0 BETWEEN 8 AND 40 carries,
         hap = 1 AND anchor - pos0 BETWEEN 8 AND 30 gapped FROM reads0),
alignments AS (
  SELECT fid, mate, concat('r', CAST(fid AS VARCHAR)) read_name, contig_idx, contig, contig_len, hap, a, pos0,
         deletes, carries, gapped, CAST(pos0 + 1 AS INT) pos, 60 mapq,
         CASE WHEN mate = 1 THEN 99 ELSE 147 END flag,
         CASE WHEN gapped AND deletes THEN concat(a, 'M3D', 50 - a, 'M')
              WHEN gapped THEN concat(a, 'M3I', 47 - a, 'M') ELSE '50M' END cigar,
         CAST(pos0 + 50 + CASE WHEN gapped THEN CASE WHEN deletes THEN 3 ELSE -3 END ELSE 0 END AS INT) ref_end,
         contig mate_contig,
         CAST(CASE WHEN mate = 1 THEN fstart + isize - 49 ELSE fstart + 1 END AS INT) mate_pos,
         CAST(CASE WHEN mate = 1 THEN isize ELSE -isize END AS INT) tlen,
         concat('rg', CAST(fid % 3 AS VARCHAR)) read_group, CASE WHEN fid % 3 < 2 THEN concat('lib', CAST(fid % 3 AS VARCHAR)) END library,
         CASE WHEN carries AND deletes THEN substr(win, off + 1, a) || substr(win, off + a + 4, 50 - a)
              WHEN carries THEN substr(win, off + 1, a) || 'TGC' || substr(win, off + a + 1, 47 - a)
              ELSE substr(win, off + 1, 50) END tmpl
  FROM reads1),
bases0 AS (
  SELECT *, CASE WHEN carries AND NOT deletes AND i >= a AND i < a + 3 THEN NULL
                 WHEN carries AND i >= a THEN pos0 + i + 1 + CASE WHEN deletes THEN 3 ELSE -3 END
                 ELSE pos0 + i + 1 END spos
  FROM (SELECT al.*, CAST(o.i AS INT) i FROM alignments al CROSS JOIN range(50) o(i)) t),
bases1 AS (
  SELECT fid, mate, read_name, contig_idx, contig, flag, read_group, library, cigar, i, mapq,
         CAST(CASE WHEN gapped THEN spos ELSE pos0 + i + 1 END AS INT) rpos,
         CASE WHEN (fid * 13 + mate * 5 + i * 7) % 101 = 0 THEN translate(substr(tmpl, i + 1, 1), 'ACGT', 'CGTA')
              WHEN spos IS NOT NULL AND (spos * 31 + contig_idx * 17) % 211 = 0 AND (spos % 2 = 0 OR hap = 1)
                THEN translate(substr(tmpl, i + 1, 1), 'ACGT', 'GTAC')
              ELSE substr(tmpl, i + 1, 1) END base,
         CAST(CASE WHEN CASE WHEN mate = 1 THEN i ELSE 49 - i END >= 46 THEN 6 + fid % 5
                   ELSE 28 + (fid + i) % 12 END AS INT) q
  FROM bases0),
bases AS (
  SELECT b.*, r.ref_base FROM bases1 b LEFT JOIN ref_bases r ON r.contig_idx = b.contig_idx AND r.rpos = b.rpos),
seqs AS (SELECT fid, mate, string_agg(base, '' ORDER BY i) seq FROM bases1 GROUP BY fid, mate),
raw_bases AS (
  SELECT fid, mate, read_name, CAST(CASE WHEN mate = 1 THEN i ELSE 49 - i END AS INT) i,
         CASE WHEN mate = 1 THEN base ELSE translate(base, 'ACGT', 'TGCA') END base, q FROM bases1),
raw_reads AS (
  SELECT fid, mate, any_value(read_name) read_name, string_agg(base, '' ORDER BY i) seq,
         string_agg(chr(q + 33), '' ORDER BY i) qual FROM raw_bases GROUP BY fid, mate),
dirty AS (
  SELECT * EXCLUDE (pos, flag), CAST(CASE WHEN fid % 97 = 0 THEN contig_len - 19 ELSE pos END AS INT) pos,
         CASE WHEN fid % 50 = 0 THEN flag + 4 ELSE flag END flag FROM alignments),
known_snps AS (
  SELECT contig_idx, contig, rpos pos, concat('rs', CAST(contig_idx::BIGINT * 1000000 + rpos AS VARCHAR)) id,
         ref_base ref, translate(ref_base, 'ACGT', 'GTAC') alt
  FROM ref_bases WHERE (rpos * 31 + contig_idx * 17) % 211 = 0),
known_indels AS (
  SELECT contig_idx, contig, anchor pos,
         CASE WHEN contig_idx % 2 = 0 THEN substr(seq, anchor, 4) ELSE substr(seq, anchor, 1) END ref,
         CASE WHEN contig_idx % 2 = 0 THEN substr(seq, anchor, 1) ELSE substr(seq, anchor, 1) || 'TGC' END alt
  FROM hosts),
targets AS (
  SELECT contig_idx, contig, CAST(w0 + s AS INT) start_pos, CAST(w0 + e AS INT) end_pos, contig || p AS name
  FROM hosts CROSS JOIN (VALUES (41, 160, 'a'), (181, 280, 'b')) v(s, e, p)),
baits AS (
  SELECT contig_idx, contig, CAST(greatest(1, start_pos - 10) AS INT) start_pos,
         CAST(end_pos + 10 AS INT) end_pos, name FROM targets)
"""


def with_chain(select: str, *more: str) -> str:
    """The chain, further named expressions, and the final select."""
    return CHAIN + "".join(f", {m}" for m in more) + "\n" + select
