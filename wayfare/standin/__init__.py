"""Trips and zones derived from star-schema tables, for tests and benchmarks."""
