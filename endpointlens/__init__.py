"""Endpoint-quality analytics as DataFrame -> DataFrame functions on Spark."""
