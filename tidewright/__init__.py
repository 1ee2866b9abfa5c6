"""Catch records joined with weather, tide and current observations, as Spark jobs."""
