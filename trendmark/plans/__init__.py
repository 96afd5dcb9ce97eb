"""Layers put together from operators."""
