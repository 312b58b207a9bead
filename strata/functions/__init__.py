"""Column expressions: calendar parts, exact sums, labels, clustering keys."""
