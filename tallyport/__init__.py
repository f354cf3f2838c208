"""Chunked table copies on Spark, and the proof that they are right.

The package plans bounded pieces of a table, copies them with a ledger, and
compares source with target.  Every operator takes DataFrames and returns a lazy
DataFrame; nothing larger than a findings table reaches the driver.
"""

from tallyport.specs import ForeignKey, Key, Rule, Table

__all__ = ["ForeignKey", "Key", "Rule", "Table"]
__version__ = "0.1.0"
