"""Batch-ranking analytics as composable DataFrame operators."""
