"""Column functions: draws, text rules, ISO 8601, quantiles."""
