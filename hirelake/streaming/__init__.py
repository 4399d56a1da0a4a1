"""File-stream wrapper around the batch state functions."""
