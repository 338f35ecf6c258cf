"""Plans: model, stand-in bindings, star builds, marts and the query catalog."""
