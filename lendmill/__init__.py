"""Credit-event analytics as Spark jobs: gate, layers, typed tables, marts, checks."""
