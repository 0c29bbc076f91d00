"""Relational and statistical operators, each DataFrame in, DataFrame out."""
