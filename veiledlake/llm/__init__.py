"""Operators for training data: their queries, and SQL where it can express them."""

from veiledlake.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
