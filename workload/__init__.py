"""Queries over the driver's tables: each operator bound to real data, with its SQL twin."""
