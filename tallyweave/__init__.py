"""Sparse count-matrix analytics on Spark: DataFrame in, DataFrame out."""
