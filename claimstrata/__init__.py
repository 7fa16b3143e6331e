"""Spark jobs that turn nested claim documents into bronze, silver and gold tables."""
