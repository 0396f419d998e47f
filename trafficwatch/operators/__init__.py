"""DataFrame operators: registry enrichment, detections and camera statistics,
de-duplication and keyed upsert, event-time rebasing and replay."""
