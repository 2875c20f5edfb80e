"""Whole jobs: read, compute, write. One function each, from paths to paths."""
