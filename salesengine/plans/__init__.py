"""Query plans: reporting pack (Q1-Q8), dashboard datasets (D1-D13), question
reports (N1-N6), the batch pipeline, and the registry of named queries."""
