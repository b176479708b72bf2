"""Airline on-time performance analytics as Spark jobs."""
