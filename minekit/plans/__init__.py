"""Whole jobs: iteration, search and model building over the operators."""
