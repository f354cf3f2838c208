"""The registered queries over the shared test tables, with their SQL twins."""
