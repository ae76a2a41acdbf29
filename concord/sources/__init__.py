"""Sources and sinks beside Spark's own: files told by content, document blocks, a content-addressed store."""
