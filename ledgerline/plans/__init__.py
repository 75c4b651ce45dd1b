"""Report plans, the named-query registry and the SQL oracle."""
