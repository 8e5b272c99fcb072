"""Operators Spark has no scalable one-liner for."""
