"""Structured Streaming: file ingestion, upserts, watermarks, live sessions."""
