"""Spark-native analytics over daily observations, with data-quality gates and like-for-like baselines."""
