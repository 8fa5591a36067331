"""Registered checks: one Spark plan per operator (``spark.py``) and its
independent SQL statement (``oracle.py``), over the driver's test tables."""
