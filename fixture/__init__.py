"""The raw extracts as projections of the test tables, and the SQL each query is held to."""
