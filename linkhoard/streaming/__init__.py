"""Submission of URLs as they arrive."""
