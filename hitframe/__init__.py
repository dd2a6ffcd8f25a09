"""Detector-hit analytics expressed as Spark DataFrame plans."""
