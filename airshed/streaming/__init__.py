"""Structured Streaming forms: file landing -> Bronze, Gold kept current,
sliding-window failure alerts, duplicate suppression."""
