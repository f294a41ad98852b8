"""Whole-report plans: metric assembly, statements, the batch job, and the query registry."""
