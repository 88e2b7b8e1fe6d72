"""Build order of the marts, and the catalogue of queries with their SQL oracles."""
