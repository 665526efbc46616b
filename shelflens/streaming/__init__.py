"""Structured Streaming: the per-SKU sales metrics maintained incrementally."""
