"""Whole jobs: sources, operators and sinks put together."""
