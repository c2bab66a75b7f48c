"""Column-level helpers: the numeric contract, CASE labels, calendar parts."""
