"""Ratings, features and recommendations as Spark jobs."""
