"""Preparing, labelling and benchmarking short-text classification data on Spark."""
