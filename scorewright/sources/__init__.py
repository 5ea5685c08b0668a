"""Readers and writers of tables, predictions, summaries and fitted models."""
