"""Composite plans (sample builder, gap filling, tabular regression, reports) and the query catalog."""
