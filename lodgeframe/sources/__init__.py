"""Readers. Each returns a DataFrame with a fixed schema, empty when nothing was delivered."""
