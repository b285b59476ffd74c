"""Whole loads, each one function over the operators."""
