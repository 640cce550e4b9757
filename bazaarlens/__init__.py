"""Commerce and creator analytics as DataFrame-to-DataFrame functions on Spark."""
