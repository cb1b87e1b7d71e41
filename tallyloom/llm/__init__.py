"""Operators on training text: each module holds one operator, queries.py the registered queries."""
