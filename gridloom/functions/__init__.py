"""Column expressions: cell ids, tags, roads, census rules, classes, geometry, projection."""
