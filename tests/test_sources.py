import datetime
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tilewright.operators import column_stats, leading_key_column, lob_columns, partition_info, range_boundaries, user_schemas
from tilewright.session import local_frame, materialize, shared_folder
from tilewright.sources import (
    POSTGRES,
    SQL_SERVER,
    JdbcServer,
    TableSpec,
    build_catalog,
    read_catalog,
    read_databases,
    read_query,
    read_schemas,
    read_table,
    read_tables,
    session_catalog,
    session_databases,
)
from tilewright.sources import jdbc
from tilewright.sources.catalog import COLUMNS, UNBOUNDED


def lobs_of(c):
    return sorted((r.table, r.column) for r in lob_columns(c.columns, c.tables, c.schemas, c.types).collect())


def test_build_catalog(spark):
    frames = {
        "b": local_frame(spark, [(1, "x"), (2, "y" * 8001)], "id int, measured string"),
        "a": local_frame(spark, [(1, "x", 1), (2, None, 1), (3, "z", 2)], "id int, short string, p int"),
    }
    specs = {"b": TableSpec(key=["id"]), "a": TableSpec(partition_by=F.col("p"), lengths={"short": 8})}
    c = build_catalog(spark, frames, specs)
    assert lobs_of(c) == [("b", "measured")]
    assert {r.name: r.object_id for r in c.tables.collect()} == {"a": 1001, "b": 1002}
    info = {r.object_id: (r.rows, r.PartitionCount) for r in partition_info(c.tables, c.indexes, c.partitions).collect()}
    assert info == {1001: (3, 2), 1002: (2, 0)}
    keys = {r.TableName: r.first_column for r in leading_key_column(c).collect()}
    assert keys == {"a": None, "b": "id"}


def test_undeclared_length_is_unbounded(spark):
    frames = {"t": local_frame(spark, [("x",), (None,)], "v string"), "empty": local_frame(spark, [], "v string")}
    assert lobs_of(build_catalog(spark, frames)) == [("empty", "v"), ("t", "v")]


def test_columns_cost_no_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    local_frame(spark, [("x",)], "v string").write.parquet(path)
    c = build_catalog(spark, {"t": spark.read.parquet(path)}, {})
    keys = leading_key_column(c)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in keys and lobs_of(c) == [("t", "v")]
    assert "Scan parquet" not in c.columns._jdf.queryExecution().executedPlan().toString()


def test_check_keys(spark):
    frames = {
        "full": local_frame(spark, [(1,)], "id int"),
        "holes": local_frame(spark, [(1,), (None,)], "id int"),
        "empty": local_frame(spark, [], "id int"),
    }
    specs = {t: TableSpec(key=["id"]) for t in frames}
    for check, holes in ((True, None), (False, "id")):
        keys = {r.TableName: r.first_column for r in leading_key_column(build_catalog(spark, frames, specs, check_keys=check)).collect()}
        assert keys == {"full": "id", "holes": holes, "empty": "id"}


def test_catalog_union(spark):
    frame = {"t": local_frame(spark, [(1,)], "id int")}
    both = build_catalog(spark, frame, schema="one").union(
        build_catalog(spark, frame, schema="two", schema_id=2, first_object_id=2001)
    )
    assert {r.SchemaName for r in leading_key_column(both).collect()} == {"one", "two"}


def test_session_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.sql("DROP TABLE IF EXISTS shop.sales")
    spark.sql("CREATE TABLE shop.sales (id INT, note STRING, code VARCHAR(20), day STRING) USING parquet PARTITIONED BY (day)")
    spark.sql("INSERT INTO shop.sales VALUES (1, 'n', 'c', 'mon'), (2, 'n', 'c', 'tue'), (3, 'n', 'c', 'tue')")
    c, tables = session_catalog(spark, "shop", keys={"sales": ["id"]})
    assert set(tables) == {"shop.sales"}
    assert lobs_of(c) == [("sales", "day"), ("sales", "note")]
    assert [(r.rows, r.PartitionCount) for r in partition_info(c.tables, c.indexes, c.partitions).collect()] == [(3, 2)]
    assert "shop" in [r.schema_name for r in user_schemas(session_databases(spark)).collect()]


def test_session_catalog_by_statistics(spark):
    """Rows and partitions of analysed tables come from the catalog; no file is looked at."""
    spark.sql("CREATE DATABASE IF NOT EXISTS analysed")
    for name in ("plain", "parted", "unknown"):
        spark.sql(f"DROP TABLE IF EXISTS analysed.{name}")
        writer = spark.range(30).selectExpr("id", "id % 4 AS p").write
        (writer.partitionBy("p") if name == "parted" else writer).saveAsTable(f"analysed.{name}")
    for name in ("plain", "parted"):
        spark.sql(f"ANALYZE TABLE analysed.{name} COMPUTE STATISTICS")
    expected = {"plain": (30, 0), "parted": (30, 4), "unknown": (30, 0)}
    for statistics in (False, True):
        catalog, frames = session_catalog(spark, "analysed", statistics=statistics)
        rows = partition_info(catalog.tables, catalog.indexes, catalog.partitions)
        named = rows.join(catalog.tables, "object_id").select("name", "rows", "PartitionCount").collect()
        assert {r.name: (r.rows, r.PartitionCount) for r in named} == expected
        plan = catalog.partitions._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") == (1 if statistics else 3)
        assert sorted(frames) == ["analysed.parted", "analysed.plain", "analysed.unknown"]


def test_all_tables_in_one_aggregate(spark):
    """Empty tables, partitions by any type, nulls among their values."""
    frames = {
        "empty": spark.range(0),
        "none": spark.range(0).withColumn("p", F.lit(1)),
        "day": local_frame(spark, [(datetime.date(2024, 1, 1),), (None,), (None,), (datetime.date(2024, 1, 2),)], "p date"),
        "pair": local_frame(spark, [(1, None), (1, "x"), (None, None), (1, "x")], "a int, b string"),
        "bytes": local_frame(spark, [(b"\xff",), (b"\xfe",), (b"\xff",)], "p binary"),
        "null": local_frame(spark, [(None,), (None,)], "p int"),
    }
    by = {"none": F.col("p"), "day": F.col("p"), "pair": F.struct("a", "b"), "bytes": F.col("p"), "null": F.col("p")}
    catalog = build_catalog(spark, frames, {t: TableSpec(partition_by=c) for t, c in by.items()})
    held = catalog.partitions.join(catalog.tables, "object_id").groupBy("name").agg(
        F.sort_array(F.collect_list("rows")).alias("rows"), F.count_distinct("partition_number").alias("parts")
    )
    assert {r.name: (r.rows, r.parts) for r in held.collect()} == {
        "empty": ([0], 1), "day": ([1, 1, 2], 3), "pair": ([1, 1, 2], 3), "bytes": ([1, 2], 2), "null": ([2], 1),
    }
    plan = catalog.partitions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_shared_folder_must_be_shared(spark, monkeypatch):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default=None: "file:/tmp/w" if "warehouse" in name else default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Elsewhere)
    Elsewhere.sparkContext.master = "local[4]"
    assert shared_folder(Elsewhere) == "file:/tmp/w/_stored"


def test_materialize(spark):
    df = materialize(local_frame(spark, [(1, "x")], "id int, v string"), "kept")
    assert [tuple(r) for r in df.collect()] == [(1, "x")]
    assert all(f.startswith("file:" + shared_folder(spark)) or shared_folder(spark) in f for f in df.inputFiles())


def test_local_frame_is_a_local_relation(spark):
    plan = local_frame(spark, [], COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan


class Reader:
    """Stands in for spark.read and records what it is asked for."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def format(self, name):
        self.current = {"format": name}
        return self

    def options(self, **options):
        self.current |= options
        return self

    def option(self, name, value):
        self.current[name] = value
        return self

    def load(self):
        self.calls.append(self.current)
        return self.current

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self.calls[-1]


SERVER = JdbcServer(SQL_SERVER, "db.example", "reader", "hidden")


def test_server_options():
    assert SERVER.options()["url"] == "jdbc:sqlserver://db.example:1433;databaseName=master;encrypt=true"
    postgres = JdbcServer(POSTGRES, "pg.example", "u", "p", database="app", port=5433)
    assert postgres.options()["url"] == "jdbc:postgresql://pg.example:5433/app"
    assert "hidden" not in repr(SERVER)


def test_jdbc_catalog():
    reader = Reader()
    c = read_catalog(reader, SERVER)
    assert c.tables["query"].endswith("FROM sys.tables")
    assert len(reader.calls) == 7 and all(call["format"] == "jdbc" for call in reader.calls)
    assert read_query(reader, SERVER, jdbc.SCHEMA_LIST)["query"] == jdbc.SCHEMA_LIST


def test_jdbc_tables():
    reader = Reader()
    assert set(read_tables(reader, SERVER, ["dbo.a", "dbo.b"])) == {"dbo.a", "dbo.b"}
    whole = read_table(reader, SERVER, "dbo.a")
    assert whole["dbtable"] == "dbo.a" and whole["fetchsize"] == "10000"


def test_sliced_tables(spark):
    found = range_boundaries(spark.range(30).withColumnRenamed("id", "k]"), "k]", 3)
    reader = Reader()
    parts = read_tables(reader, SERVER, ["dbo.a", "dbo.b"], {"dbo.a": ("k]", found)})
    assert parts["dbo.a"]["predicates"] == [
        "([k]]] < 10 OR [k]]] IS NULL)", "([k]]] >= 10 AND [k]]] < 20)", "([k]]] >= 20)",
    ]
    assert "predicates" not in parts["dbo.b"]


KEYS = {
    "int": [None, 1, 3, 3, 3, 3, 3, 9, 12, 70],
    "decimal(12,2)": [None, Decimal("-1.50"), Decimal("0.25"), Decimal("7.00"), Decimal("7.01"), None, Decimal("9")],
    "double": [0.1, -2.5, 1e300, None, 3.0, 1e-7],
    "string": [None, "", "it's", "O'Neil", "Zoë", "a", "B", "é", "中", 'x"y', "a", "b"],
    "date": [None, datetime.date(1969, 12, 31), datetime.date(2020, 2, 29), datetime.date(2024, 1, 1)],
    "timestamp": [None, datetime.datetime(2020, 1, 1, 0, 0, 0, 1), datetime.datetime(2020, 1, 1), datetime.datetime(2021, 6, 5, 4)],
    "boolean": [True, False, None, True, False, True],
}


@pytest.mark.parametrize("dtype", KEYS)
def test_predicates_cover_every_row_once(spark, dtype):
    """The server's SQL, run by another engine with the same forms."""
    keys = KEYS[dtype] * 3
    kind = dtype.replace("timestamp", "timestamp_ntz")
    df = local_frame(spark, [(k,) for k in keys], f"k {kind}")
    plain = {**POSTGRES, "text_order": "C"}
    predicates = jdbc.range_predicates(plain, "k", range_boundaries(df, "k", 4))
    assert 2 <= len(predicates) <= 4
    with duckdb.connect() as db:
        db.execute(f"create table t (k {'varchar' if dtype == 'string' else dtype})")
        db.executemany("insert into t values (?)", [(k,) for k in keys])
        counts = [db.execute(f"select count(*) from t where {p}").fetchone()[0] for p in predicates]
    assert sum(counts) == len(keys) and min(counts) > 0


@pytest.fixture
def in_zone(spark):
    def change(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)

    yield change
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone, first", [
    ("Europe/Berlin", "2024-10-26 23:00:00"), ("Europe/Berlin", "2024-03-31 00:00:00"),
    ("America/New_York", "2024-11-03 04:00:00"), ("Australia/Lord_Howe", "2024-04-06 13:00:00"),
])
def test_instants_across_a_change_of_the_clock(spark, in_zone, zone, first):
    """240 minutes while clocks change: every row is read once, whatever zones Spark and the server are in."""
    start = datetime.datetime.fromisoformat(first + "+00:00").timestamp()
    in_zone(zone)
    df = spark.range(240).select(F.timestamp_seconds(F.col("id") * 60 + int(start)).alias("k"))
    predicates = jdbc.range_predicates(POSTGRES, "k", range_boundaries(df, "k", 24))
    assert len(predicates) == 24
    stats = column_stats(df, "t", exact_distinct=True).first()
    assert stats.distinct_count == 240
    with duckdb.connect() as db:
        for server_zone in (zone, "Asia/Tokyo"):
            db.execute(f"set timezone = '{server_zone}'")
            db.execute(f"create or replace table t as select to_timestamp({start} + 60 * i) as k from range(240) r(i)")
            counts = [db.execute(f"select count(*) from t where {p}").fetchone()[0] for p in predicates]
            assert counts == [10] * 24


def test_instants_by_dialect(spark):
    df = spark.range(2).select(F.timestamp_micros(F.col("id") * 1_500_000 - 1).alias("k"))
    found = range_boundaries(df, "k", 2)
    assert jdbc.range_predicates(SQL_SERVER, "k", found)[1] == "([k] >= CAST('1970-01-01 00:00:01.499999 +00:00' AS datetimeoffset(6)))"
    assert jdbc.range_predicates(POSTGRES, "k", found)[1] == "(\"k\" >= CAST('1970-01-01 00:00:01.499999+00' AS timestamptz))"
    assert SERVER.options()["preferTimestampNTZ"] == "true"


def test_boundaries_out_of_order(spark):
    wrong = local_frame(spark, [(1, 9), (2, 7), (3, 5)], "loc int, min_val int")
    with pytest.raises(ValueError, match="ascending"):
        jdbc.range_predicates(POSTGRES, "k", wrong)


def test_predicates_by_dialect(spark):
    df = local_frame(spark, [(k,) for k in [b"a", b"b", b"c"]], "k binary")
    found = range_boundaries(df, "k", 2)
    assert jdbc.range_predicates(SQL_SERVER, "k", found)[1] == "([k] >= 0x63)"
    assert jdbc.range_predicates(POSTGRES, 'k"', found)[1] == "(\"k\"\"\" >= decode('63', 'hex'))"
    text = range_boundaries(local_frame(spark, [("a",), ("b",)], "k string"), "k", 2)
    assert jdbc.range_predicates(SQL_SERVER, "k", text) == [
        "([k] COLLATE Latin1_General_100_BIN2 < N'b' OR [k] IS NULL)",
        "([k] COLLATE Latin1_General_100_BIN2 >= N'b')",
    ]
    nothing = range_boundaries(spark.range(0), "id", 2)
    assert jdbc.range_predicates(POSTGRES, "id", nothing) == ["1 = 1"]


def test_name_lists(spark, monkeypatch):
    frames = {
        SQL_SERVER["databases"]: local_frame(spark, [("master", "ONLINE"), ("shop", "ONLINE")], "name string, state_desc string"),
        POSTGRES["databases"]: local_frame(spark, [("app", False, True)], "datname string, datistemplate boolean, datallowconn boolean"),
        jdbc.SCHEMA_LIST: local_frame(spark, [("public",), ("pg_catalog",)], "schema_name string"),
    }
    monkeypatch.setattr(jdbc, "read_query", lambda spark, server, query: frames[query])
    postgres = JdbcServer(POSTGRES, "pg.example", "u", "p")
    assert [r[0] for r in read_databases(spark, SERVER).collect()] == ["shop"]
    assert [r[0] for r in read_databases(spark, postgres).collect()] == ["app"]
    assert [r[0] for r in read_schemas(spark, postgres).collect()] == ["public"]


def test_many_tables_write_nothing(spark):
    frames = {f"t{i:02}": spark.range(i) for i in range(40)}
    before = set(os.listdir(shared_folder(spark))) if os.path.isdir(shared_folder(spark)) else set()
    catalog = build_catalog(spark, frames)
    assert sum(r.rows for r in catalog.partitions.collect()) == sum(range(40))
    after = set(os.listdir(shared_folder(spark))) if os.path.isdir(shared_folder(spark)) else set()
    assert after == before
