"""Structured Streaming: the four detection queries, their idempotent store
writer, the optional parse-once ingest stage and progress counters."""
