"""Whole jobs: layer runs, training and serving."""
