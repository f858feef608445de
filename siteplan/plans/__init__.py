"""Whole jobs from stored inputs to stored outputs; every path is an argument."""
