"""Document-consistency analytics expressed as Spark DataFrame plans."""
