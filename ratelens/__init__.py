"""Rate-filing analytics as plain PySpark DataFrame functions."""
