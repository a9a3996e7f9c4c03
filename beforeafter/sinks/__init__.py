"""Writing, schema matching and publishing."""

from beforeafter.sinks.conform import conform, load, load_rejects, loaded, split_rejects
from beforeafter.sinks.publish import Layout, publish, published, write_sorted

__all__ = ["Layout", "conform", "load", "load_rejects", "loaded", "publish", "published", "split_rejects", "write_sorted"]
