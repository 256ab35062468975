"""Structured Streaming: trip file arrival, landing and month upserts."""
