"""End-to-end plans: treatment, analysis, and the queries registered over the given tables."""
