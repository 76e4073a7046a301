from tilewright.operators import name_search, user_databases, user_pg_databases, user_schemas
from tilewright.session import local_frame


def names(df):
    return sorted(r[0] for r in df.collect())


def test_databases(spark):
    df = local_frame(
        spark,
        [("master", "ONLINE"), ("tempdb", "ONLINE"), ("shop", "ONLINE"), ("old", "OFFLINE"), ("unknown", None)],
        "name string, state_desc string",
    )
    assert names(user_databases(df)) == ["shop"]


def test_pg_databases(spark):
    df = local_frame(
        spark,
        [("postgres", False, True), ("template0", True, False), ("template1", True, True), ("closed", False, False)],
        "datname string, datistemplate boolean, datallowconn boolean",
    )
    # The maintenance database itself is listed.
    assert names(user_pg_databases(df)) == ["postgres"]


def test_schemas(spark):
    listed = ["public", "pg_catalog", "information_schema", "pg_toast", "pg_toast_1", "pgXtoast", "pg_temp_3", "pg", "Sales"]
    df = local_frame(spark, [(n,) for n in listed], "schema_name string")
    assert names(user_schemas(df)) == ["Sales", "pg", "public"]


def test_search(spark):
    df = local_frame(spark, [("Orders",), ("reorder",), ("100%_ORDER",), ("item",), (None,)], "name string")
    assert names(name_search(df, "name", "oRder")) == ["100%_ORDER", "Orders", "reorder"]
    assert names(name_search(df, "name", "%_")) == ["100%_ORDER"]
    assert len(names(df.where("name is not null"))) == len(names(name_search(df, "name", "")))
