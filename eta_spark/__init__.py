"""Delivery-time analytics and ETA regression on Spark DataFrames."""
