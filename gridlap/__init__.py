"""Lap-timing analytics as Spark DataFrame operators."""
