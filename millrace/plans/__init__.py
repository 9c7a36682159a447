"""Operators chained into the preparation stages and the model experiments."""
