"""Operators: the cleaning steps (T1-T11), the rollups, summary tables
(A1-A3, P1) and the data-set generator (G1)."""
