"""Spark jobs that clean, integrate and analyse city service requests, businesses and reviews."""

__version__ = "0.1.0"
