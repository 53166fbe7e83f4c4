"""kestrel.operators."""
