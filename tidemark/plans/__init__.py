"""Logical plans: the model graph and stand-in inputs built from the driver tables."""
