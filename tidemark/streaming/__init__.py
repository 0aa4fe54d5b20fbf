"""Structured Streaming versions: bars, de-duplication, recursive state, restatement, settlement."""
