"""Streaming queries: the batch operators behind a source, a checkpoint and a sink."""
