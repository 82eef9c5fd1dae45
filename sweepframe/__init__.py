"""Sweep analytics on Spark."""
