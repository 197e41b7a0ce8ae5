"""Column expressions: no DataFrame, no session, no Python UDF."""
