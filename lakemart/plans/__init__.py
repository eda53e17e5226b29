"""Registered queries over the driver tables (``queries()`` / ``oracle_sql()``)."""
