"""Seismic-network analytics as Spark DataFrame, Structured Streaming and Spark ML plans."""
