"""Chained stages, the mapping of the given tables onto a panel, and the registered queries."""
