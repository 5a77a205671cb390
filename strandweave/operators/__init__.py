"""Operators on reads, alignments, pileups and calls."""
