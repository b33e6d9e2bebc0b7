"""Composed plans: the registered query set and multi-operator reports."""
