"""ledgertalk: retail transactions to analysis tables and chat examples, on Spark DataFrames."""

from ledgertalk.config import Recipe

__all__ = ["Recipe"]
