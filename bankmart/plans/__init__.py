"""Compositions of operators: cleaned tables, dimensional model, KPI series."""
