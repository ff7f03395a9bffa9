"""Point-in-time (bitemporal) data operators for PySpark."""
