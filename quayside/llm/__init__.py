"""Operators for preparing training text: ten operators, their queries, and what those share."""
