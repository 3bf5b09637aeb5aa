"""Column helpers: pure expressions over built-in Spark functions."""
