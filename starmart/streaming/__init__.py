"""Streaming entry points (the reference has none; this feeds W15 from files)."""
