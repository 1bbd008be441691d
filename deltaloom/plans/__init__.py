"""Whole plans built from the operators: a change log in, destination tables out."""
