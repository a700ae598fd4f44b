"""Batch and streaming analytics over short text posts, as DataFrame-to-DataFrame operators."""
