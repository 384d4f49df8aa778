"""Table builders, measures and the load job."""
