"""Operators Spark has no single call for; plain ``DataFrame -> DataFrame`` functions."""
