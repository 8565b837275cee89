"""Change-log analytics on Spark: decode, assemble, render, replay and verify database change logs."""

__version__ = "0.1.0"
