"""All registered queries: name -> (function, SQL for the check or None)."""

from sylvatab.queries import database, names, relational

QUERIES = {**relational.QUERIES, **names.QUERIES, **database.QUERIES}
