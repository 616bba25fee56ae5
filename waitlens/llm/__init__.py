"""Operators of a training-data pipeline (see the README section of the same name).

Nothing else in the library imports this package. ``queries.QUERIES`` holds the
registered queries and ``queries.ORACLE_SQL`` the SQL for those that SQL can express.
"""
