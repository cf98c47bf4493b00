"""Operators for building training data: one module per operator, queries and oracle SQL in `queries`."""
