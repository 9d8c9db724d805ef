"""Subscription-revenue analytics on Spark."""
