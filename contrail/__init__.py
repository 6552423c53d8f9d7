"""Airspace-observation analytics expressed as Spark DataFrame functions."""
