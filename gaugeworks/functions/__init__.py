"""Column builders: cleaning rules and frame aggregates."""
