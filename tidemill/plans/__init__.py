"""Whole jobs: operators, sources and sinks put together."""
