"""Column builders shared by batch and streaming."""
