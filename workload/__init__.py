"""A variant cohort derived from the benchmark tables, with its queries and their SQL twins."""
