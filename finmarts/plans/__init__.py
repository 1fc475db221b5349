"""Table definitions: clean layer, dimensions, facts, monthly aggregates and marts."""
