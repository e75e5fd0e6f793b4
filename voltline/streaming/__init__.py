"""Structured Streaming jobs: Bronze, Silver (foreachBatch upsert), Gold."""
