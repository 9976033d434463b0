"""Column -> Column functions."""

from tidemill.functions import clean, json, keys, ledger, vector

__all__ = ["clean", "json", "keys", "ledger", "vector"]
