"""Checked queries over the fixture tables: Spark plans and the SQL they must equal."""
