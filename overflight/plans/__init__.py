"""Compositions of operators: the daily build and its stored layers."""
