"""Spark DataFrame operators for area-level risk features and count-model training sets."""
