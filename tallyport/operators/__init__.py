"""Operators over DataFrames: chunks, comparison, keys, quality, copy and ledger."""
