"""Layer operators: validation and quarantine, the daily Gold aggregate, checks."""
