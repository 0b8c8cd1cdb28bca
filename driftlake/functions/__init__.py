"""Column expressions: clocks and buckets, JSON records, facets, text and scores."""
