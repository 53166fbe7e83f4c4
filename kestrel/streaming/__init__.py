"""kestrel.streaming."""
