"""Every operator as a query over the star-schema tables, with equivalent SQL."""

from relweave.gallery import checks, modelling, questions, scans, values  # noqa: F401  (registers the queries)
from relweave.gallery.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
