"""Rank rare variants of a whole cohort against population null tables, on Spark."""
