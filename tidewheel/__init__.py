"""Recommendation and stream analytics on rating data, as DataFrame functions for Spark."""
