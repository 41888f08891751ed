"""Structured Streaming jobs: order ingest, dedup, windowed revenue, status advance, month refresh."""
