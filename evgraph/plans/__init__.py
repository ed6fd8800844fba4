"""Scratch tables and the projection of the driver tables on the graph model."""
