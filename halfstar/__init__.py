"""Batch analytics on item ratings and user tags, as PySpark DataFrame functions."""
