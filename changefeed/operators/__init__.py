"""Operators over feeds, positions and shard catalogues; DataFrames in and out."""
