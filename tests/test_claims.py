"""What the registry claims: whole tables, and SQL wherever SQL can say it."""

from curbline.plans import registry

#: Queries without SQL, each held against brute force by a test of its own.
WITHOUT_SQL = {"routes", "event_duplicates"}


def test_no_query_stands_beside_a_restricted_one():
    assert not [n for n in registry.QUERIES if n.endswith("_whole")]


def test_queries_have_sql():
    assert {n for n, q in registry.QUERIES.items() if not q.sql} == WITHOUT_SQL
