"""Whole refreshes and the registered queries."""
