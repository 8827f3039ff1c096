"""Whole jobs: store a split, train and publish, score, evaluate, compare."""
