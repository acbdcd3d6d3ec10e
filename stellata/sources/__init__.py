"""Readers for the raw inputs and sinks for the results."""
