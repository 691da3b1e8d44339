"""Retail operations analytics and report processing on Spark."""
