"""Streaming form of the incremental load (availableNow over a landing folder)."""
