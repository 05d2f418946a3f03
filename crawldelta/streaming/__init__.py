"""Structured Streaming forms of the change counts, the all-time table and the breaker."""
