"""Structured Streaming: windowed revenue and the fan-out order pipeline."""
