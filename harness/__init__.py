"""Check queries: the library's views and operators over the given tables, beside their plain SQL."""
