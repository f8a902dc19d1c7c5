"""Queries of the engine over the driver's tables."""
