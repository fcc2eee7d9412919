"""Delivery-log and message-stream analytics on Spark DataFrames."""
