"""Listings-market analytics as Spark jobs."""
