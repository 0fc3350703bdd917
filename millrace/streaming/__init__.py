"""Structured-streaming operators."""
