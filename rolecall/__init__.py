"""Job-posting analytics as plain ``DataFrame -> DataFrame`` functions for Spark."""
