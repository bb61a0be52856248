"""Change feeds on PySpark: read, position, bound, resume and track sharded streams."""

from changefeed.schema import ENVELOPE, POSITIONS, SHARD_KEY, event_schema

__all__ = ["ENVELOPE", "POSITIONS", "SHARD_KEY", "event_schema"]
