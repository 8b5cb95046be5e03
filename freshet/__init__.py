"""Seasonal and yearly series analytics as Spark DataFrame jobs."""
