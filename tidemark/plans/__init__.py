"""Compositions of operators: mirror, export, catalog profile, report copy."""
