"""Queries over the driver's tables, with independent SQL for the same results."""
