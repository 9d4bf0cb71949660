"""Structured Streaming jobs built from the same steps as the batch run."""
