"""End-to-end analyses composed from operators."""
