"""Jobs over the zones, and the queries that run the operators on the supplied tables."""
