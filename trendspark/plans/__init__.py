"""Multi-step plans built from operators."""
