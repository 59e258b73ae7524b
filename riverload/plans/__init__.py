"""Whole computations: operators in sequence, with stages where a table is used again."""
