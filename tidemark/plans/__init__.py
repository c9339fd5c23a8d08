"""Silver, star schema, marts and reports built from the operators."""
