"""Column functions: scalars, calendar rules, status labels and process-list text."""
