import __spark_entry__ as entry


def test_every_own_query_has_sql_and_none_needs_a_session_to_be_listed():
    own, sql = entry._q(), entry._oracle_sql()
    assert set(own) == set(sql) and all(isinstance(x, str) for x in sql.values())
