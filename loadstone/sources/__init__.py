"""Inputs: delimited text and tables."""
