"""Spark-native building blocks for scoring credit applicants and auditing the scores."""
