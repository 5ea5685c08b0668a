"""Queries over the test tables: the applicant view, every operator on it, and the SQL twins."""
