"""Schemas and fixed format values shared by readers, operators and sinks.

Coordinates are 1-based and closed everywhere; readers of half-open formats
convert on the way in.
"""

from pyspark.sql import types as T

# Flag bits of the public SAM format.
PAIRED = 0x1
PROPER = 0x2
UNMAPPED = 0x4
MATE_UNMAPPED = 0x8
REVERSE = 0x10
MATE_REVERSE = 0x20
FIRST = 0x40
SECOND = 0x80
SECONDARY = 0x100
QC_FAIL = 0x200
DUPLICATE = 0x400
SUPPLEMENTARY = 0x800

#: rows a caller must not look at
NOT_CALLABLE = UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE | SUPPLEMENTARY
#: rows that are not the one primary line of a read
NOT_PRIMARY = SECONDARY | SUPPLEMENTARY

#: width of one stored reference block, and how many bases of the next block
#: each one repeats so that an ordinary read needs only the block it starts in
BLOCK = 1000
OVERLAP = 1000

READ_GROUP = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sample", T.StringType()),
    T.StructField("library", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("unit", T.StringType()),
])

ALIGNMENT_COLUMNS = [
    "read_name", "mate", "flag", "contig_idx", "contig", "pos", "mapq", "cigar",
    "mate_contig", "mate_pos", "tlen", "seq", "quals", "read_group", "tags",
]
