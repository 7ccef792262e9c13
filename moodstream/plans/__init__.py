"""Whole jobs: train, evaluate, score, retrain, and the registered query catalogue."""
