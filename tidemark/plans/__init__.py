"""Registered queries of the market operators and their equivalents in SQL."""
