import math

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terracell import queries as engine
from terracell.functions import geometry, keys, tags
from terracell.plans import partitions

SF = "/root/testdata/sf0.001"


def shown(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = engine.queries()[name](spark, SF)
    want = con.sql(engine.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(tuple(map(shown, r)) for r in got.collect()) == sorted(tuple(shown(r[i]) for i in at) for r in want.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 20


def test_keys_round_trip(spark):
    k = spark.range(-32768, 32768).select(F.col("id").cast("smallint").alias("k"))
    assert k.where(keys.coarse(keys.from_coarse(F.col("k"))) != F.col("k")).count() == 0
    f = spark.createDataFrame([(1,), (-1,), (2147483647,), (-2147483647,)], "k int")
    assert f.where(keys.fine(keys.from_fine(F.col("k"))) != F.col("k")).count() == 0
    got = spark.sql("select cast(25764 as smallint) k").select(F.lower(F.hex(keys.from_coarse(F.col("k")))), keys.parent(F.col("k"))).first()
    assert tuple(got) == ("8364a4fffffffff", 25767)


E_KIND = "e array<struct<k:string,v:string>>"


@pytest.mark.parametrize(
    ("given_", "want"),
    [([], None), ([("b", "1"), ("a", "2"), ("b", "3")], {"a": "2", "b": "1"}), ([(" ", "x"), ("c", "\t")], None), ([("k", 'a"b\\c\n')], {"k": 'a"b\\c\n'})],
)
def test_tag_map(spark, given_, want):
    assert spark.createDataFrame([(given_,)], E_KIND).select(tags.tag_map(F.col("e"))).first()[0] == want


def test_text_forms(spark):
    row = spark.createDataFrame([([("k", 'a"b\\c\n'), ("\U0001f600", "x")],)], E_KIND).select(tags.hstore(tags.tag_map(F.col("e"))), tags.stored_size(F.col("e"))).first()
    assert row[0] == '"k"=>"a\\"b\\\\c\\n","\U0001f600"=>"x"'
    assert row[1] == 1 + 1 + 6 + 2 + 1 + 1  # an astral character is two units


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50)), min_size=1, max_size=25))
def test_smallest_circle_holds_all(points):
    ps = [(float(a), float(b)) for a, b in points]
    x, y, r = geometry.smallest_circle(ps)
    assert all(math.dist((x, y), p) <= r + 1e-9 for p in ps)
    assert r <= max(math.dist(p, q) for p in ps for q in ps) / math.sqrt(3) + 1e-9  # Jung's bound


def test_geodesic(spark):
    row = spark.sql("select 0D lat, 1D d").select(geometry.geodesic(F.col("lat"), F.col("d"))).first()[0]
    assert abs(row - geometry.MAJOR * math.pi / 180) < 1e-6


def test_plan_covers_all_keys(spark):
    cells = spark.range(0, 5000).select(((F.col("id") * 7919) % 60000 - 30000).cast("smallint").alias("h33"), (F.col("id") % 97 + 1).alias("size"))
    rows = sorted(partitions.plan(cells, 0.1).collect())
    assert rows[0]["lo"] == keys.LOWEST and rows[-1]["hi"] == keys.HIGHEST
    assert all(a["hi"] == b["lo"] for a, b in zip(rows, rows[1:], strict=False))
    assert sum(r["size"] for r in rows) == cells.agg(F.sum("size")).first()[0]
    assert partitions.assigned(cells, partitions.plan(cells, 0.1)).count() == 5000
