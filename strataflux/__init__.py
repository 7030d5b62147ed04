"""Layered (bronze, silver, gold) processing of sensor readings as Spark jobs."""
