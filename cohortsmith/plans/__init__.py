"""Feature-family wiring, the query registry and the SQL oracle."""
