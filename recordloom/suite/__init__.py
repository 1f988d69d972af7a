"""Every operator bound to the benchmark tables, with the SQL that states the expected result."""

from recordloom.suite.base import QUERIES

from recordloom.suite import sources, cleaning, tables, auditing, matching, merging, streams  # noqa: E402,F401

__all__ = ["QUERIES"]
