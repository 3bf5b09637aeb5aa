"""Registered queries: the driver's tables in transit shape, and their SQL twins."""
