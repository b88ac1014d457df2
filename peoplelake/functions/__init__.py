"""Column helpers and skew-safe ordered operators."""
