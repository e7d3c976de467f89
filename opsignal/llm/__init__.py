"""Operators for preparing training text, each under its named method, and their queries."""
