"""Column functions: canonical text, fingerprints, names, types and conversions."""
