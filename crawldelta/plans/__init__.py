"""Shared plan shapes and the end-to-end daily jobs."""
