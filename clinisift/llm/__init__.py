"""Operators that prepare training text: each one is a Spark job over whole tables."""
