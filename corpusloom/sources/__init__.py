"""Readers: delimited tables, page records, ground truth mark-up, range lists."""
