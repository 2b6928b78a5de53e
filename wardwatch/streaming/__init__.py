"""Structured Streaming jobs that give the same answers as the batch operators."""
