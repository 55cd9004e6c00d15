"""All operators as named queries over the test tables, with their SQL counterparts."""

from veiledlake.catalogue import columns, feeds, governance, merges, tokens  # noqa: F401
from veiledlake.catalogue.columns import clean_latest
from veiledlake.catalogue.registry import QUERIES

__all__ = ["QUERIES", "clean_latest"]
