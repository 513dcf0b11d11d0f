"""DataFrame operators (each returns a lazy DataFrame)."""
