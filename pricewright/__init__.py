"""Pricing analytics operators for Spark: plain DataFrame -> DataFrame functions."""
