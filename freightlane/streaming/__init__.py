"""Resumable loads on Structured Streaming."""
