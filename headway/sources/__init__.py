"""Landing documents, layer tables, run state."""
