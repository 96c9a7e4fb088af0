"""Composed plans: model DAG, load job, query registry and oracle SQL."""
