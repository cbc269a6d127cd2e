"""User-level jobs composed from the operators, and fixture views over test tables."""
