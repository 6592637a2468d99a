from metrolake.llm import registry


def test_registry_has_every_operator_and_sql_as_text():
    q, sql = registry.queries(), registry.oracle_sql()
    assert {k.split("_")[0] for k in q} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert set(sql) < set(q) and all(isinstance(x, str) and "SELECT" in x for x in sql.values())
