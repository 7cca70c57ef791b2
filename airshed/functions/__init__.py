"""Expressions shared by the operators and reports (all built-in Spark functions)."""
