"""Tidemark: analytics of behavioural event logs as Spark jobs."""
