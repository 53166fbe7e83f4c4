"""kestrel.plans."""
