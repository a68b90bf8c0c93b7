"""Composed plans: the batch pipeline, the query registry and the
oracle SQL used to verify it."""
