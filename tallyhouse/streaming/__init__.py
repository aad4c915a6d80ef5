"""Structured Streaming forms of the stateful batch operators."""
