"""Incremental state in batch and the Structured Streaming form of a silver load."""
