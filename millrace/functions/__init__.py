"""Column helpers and user-defined functions."""
