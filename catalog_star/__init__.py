"""Clean a catalogue and an awards table, enrich one with the other and derive a star schema, on Spark."""
