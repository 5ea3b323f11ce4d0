"""Brute-force versions that several tests use."""

from test_jaccard import brute as jaccard_brute
from test_lines import brute as lines_brute
from test_packing import hold as packing_holds

__all__ = ["jaccard_brute", "lines_brute", "packing_holds"]
