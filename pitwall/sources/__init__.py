"""Where records come from: landed JSON, the session catalogue, raw tables, the given test tables."""
