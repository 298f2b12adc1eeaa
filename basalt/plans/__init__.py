"""Registered queries (the ``queries()`` / ``oracle_sql()`` of ``__spark_entry__``)."""
