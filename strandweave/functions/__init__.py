"""Column and DataFrame helpers: CIGAR walks, base strings, intervals, scaling."""
