"""The registered queries: library calls on the given tables, and the same in SQL."""
