"""Reusable DataFrame operators; every one takes frames and column names."""
