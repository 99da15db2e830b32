"""Registered queries on the driver's tables, their inputs and their SQL twins."""
