"""Structured Streaming: message intake into bronze, and windowed event counts."""
