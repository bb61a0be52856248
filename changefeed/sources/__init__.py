"""Feeds: building the envelope, storing it and reading it, batch or streaming."""
