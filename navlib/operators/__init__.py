"""The NAV operators, grouped by report."""
