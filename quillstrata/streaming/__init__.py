"""Streams: log replay, latest decisions, stores that grow, and windows over events."""
