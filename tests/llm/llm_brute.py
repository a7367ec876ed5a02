"""Brute-force versions that several tests use."""

from test_exact_dedup import brute as exact
from test_minhash import brute as near

__all__ = ["exact", "near"]
