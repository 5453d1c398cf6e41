"""Reading die tables and catalogs, writing results."""
