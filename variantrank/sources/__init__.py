"""Readers. Each ``parse_*`` works on a DataFrame of text lines, each ``read_*`` on a path."""
