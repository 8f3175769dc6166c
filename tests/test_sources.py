"""Sources and sinks: a hand-made PBF file, and round trips."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from terracell.functions import tags
from terracell.operators import tables
from terracell.sources import fixtures, pbf, sinks


def varint(n):
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def num(k, v):
    return varint(k << 3) + varint(v)


def msg(k, data):
    return varint(k << 3 | 2) + varint(len(data)) + data


def pack(k, values):
    return msg(k, b"".join(map(varint, values)))


def zz(n):
    return n * 2 if n >= 0 else -n * 2 - 1


def deltas(values):
    return [zz(b - a) for a, b in zip([0, *values], values, strict=False)]


def block():
    strings = [b"", b"name", "Café".encode(), b"type", b"route", b"stop"]
    table = msg(1, b"".join(msg(1, s) for s in strings))
    dense = pack(1, deltas([10, 7])) + msg(5, pack(2, deltas([5, 9]))) + pack(8, deltas([100, -200])) + pack(9, deltas([-300, 400])) + pack(10, [1, 2, 0, 0])
    node = num(1, zz(-3)) + num(8, zz(1)) + num(9, zz(-1))
    way = num(1, 77) + pack(2, [1]) + pack(3, [2]) + msg(4, num(2, 8)) + pack(8, deltas([10, 7, 10])) + pack(9, deltas([100, -200, 100])) + pack(10, deltas([-300, 400, -300]))
    relation = num(1, 5) + pack(2, [3]) + pack(3, [4]) + pack(8, [5, 0]) + pack(9, deltas([7, 77])) + pack(10, [0, 1])
    return table + msg(2, msg(2, dense) + msg(1, node)) + msg(2, msg(3, way)) + msg(2, msg(4, relation))


def framed(kind, blob):
    head = msg(1, kind) + num(3, len(blob))
    return struct.pack(">I", len(head)) + head + blob


@pytest.fixture
def file(tmp_path):
    at = tmp_path / "a.pbf"
    at.write_bytes(framed(b"OSMHeader", msg(1, b"x")) + framed(b"OSMData", msg(3, zlib.compress(block()))) + framed(b"OSMData", msg(1, block())))
    return str(at)


def test_pbf_entities(spark, file):
    for split in ("1", "1000000"):
        got = pbf.read(spark, file, split_bytes=split)
        nodes = {(r.block_id, r.id): r for r in pbf.nodes(got).collect()}
        assert set(nodes) == {(b, i) for b in (0, 1) for i in (10, 7, -3)}
        first = nodes[0, 10]
        assert (first.ts_millis, round(first.lat, 9), round(first.lon, 9), [tuple(e) for e in first.entries]) == (5000, 1e-5, -3e-5, [("name", "Café")])
        assert nodes[1, 7].entries == [] and round(nodes[1, 7].lat, 9) == -2e-5 and nodes[1, -3].ts_millis is None
        way = got.where("entity = 'W' and block_id = 1").first()
        assert way.node_ids == [10, 7, 10] and [round(x, 9) for x in way.lats] == [1e-5, -2e-5, 1e-5] and way.ts_millis == 8000
        relation = pbf.relations(got).where("block_id = 0").first()
        assert [tuple(m) for m in relation.members] == [(7, "N", "stop"), (77, "W", "")]
    kept = pbf.retained(pbf.nodes(got), pbf.relations(got)).where("block_id = 0")
    assert sorted(r.id for r in kept.collect()) == [7, 10]


def test_pbf_broken(spark, tmp_path):
    at = tmp_path / "b.pbf"
    at.write_bytes(framed(b"OSMData", msg(3, b"junk")) + framed(b"OSMData", msg(1, block())))
    assert pbf.read(spark, str(at), skip_broken="true").select("block_id").distinct().collect() == [(1,)]
    with pytest.raises(Exception, match="cannot be decoded"):
        pbf.read(spark, str(at)).count()
    at.write_bytes(framed(b"OSMData", msg(1, block()))[:-3])
    with pytest.raises(Exception, match="cut off"):
        pbf.read(spark, str(at)).count()


def test_parquet_and_guard(spark, tmp_path):
    nodes = tables.nodes(fixtures.raw_nodes(spark, "/root/testdata/sf0.001"))
    sinks.parquet(nodes, f"{tmp_path}/nodes", by="h33")
    back = spark.read.parquet(f"{tmp_path}/nodes")
    assert back.count() == nodes.count() and back.select("id").exceptAll(nodes.select("id")).isEmpty()
    with pytest.raises(FileExistsError):
        sinks.parquet(nodes, f"{tmp_path}/nodes")


def test_arrow_files(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 3).select("id", (F.col("id") * 2).alias("x"))
    made = sinks.arrow_files(rows, f"{tmp_path}/arrow")
    assert made.agg(F.sum("rows")).first()[0] == 1000
    assert sinks.read_arrow(spark, f"{tmp_path}/arrow", "id long, x long").exceptAll(rows).isEmpty()


def test_text_by_cell(spark, tmp_path):
    nodes = tables.nodes(fixtures.raw_nodes(spark, "/root/testdata/sf0.001"))
    sinks.text_by_cell(sinks.node_lines(nodes), f"{tmp_path}/text")
    back = sinks.read_text(spark, f"{tmp_path}/text/*", "h33 short, h38 int, id long, point string, tags string")
    assert back.select("h33", "h38", "id").exceptAll(nodes.select("h33", "h38", "id")).isEmpty() and back.count() == nodes.count()
    r, n = back.orderBy("id").first(), nodes.orderBy("id").first()
    assert struct.unpack("<BIIdd", bytes.fromhex(r.point)) == (1, 0x20000001, 4326, n.longitude, n.latitude)
    members = spark.createDataFrame([(1, 2, 0, "N", None), (1, 3, 1, "W", "a\tb")], "relation_id long, member_id long, sequence_id int, member_type string, member_role string")
    assert [r.value for r in sinks.member_lines(members).collect()] == ["1\t2\tN\t\\N\t0", "1\t3\tW\t\"a\\tb\"\t1"]  # role in quotes, place last


def test_areas(spark):
    rows = spark.createDataFrame([("relation", "4", "0101", '"a"=>"b"'), ("way", "5", "00", "")], "kind string, id string, wkb_hex string, tags string")
    assert [tuple(r) for r in sinks.areas(rows).collect()] == [(4, bytearray(b"\x01\x01"), '{"a":"b"}')]


def test_hstore_round_trip(spark):
    odd = {'a"b\\c': "x\ny\tz", "k": "\\n", "e": "", "\U0001f600": '=>"', "v": "\\"}
    row = spark.createDataFrame([(odd,)], "m map<string,string>").select(tags.parse_hstore(tags.hstore(F.col("m"))).alias("m")).first()
    assert row.m == odd
    texts = [('"k"=>"1","a"=>NULL,"k"=>"2"', {"k": "1", "a": None}), ("", {}), ("\\N", None), (None, None)]
    got = spark.createDataFrame(texts, "t string, m map<string,string>").select(tags.parse_hstore(F.col("t")).alias("got"), "m").collect()
    assert all(r.got == r.m for r in got)


def test_way_lines(spark):
    ways = spark.createDataFrame([(7, 3, [(1, 1.0, 2.0)], [("Building", "yes"), ("n", 'a"b\\c\n')]), (8, 3, [(1, 1.0, 2.0), (2, 1.001, 2.001), (1, 1.0, 2.0)], [])], "id long, block_id long, points array<struct<node_id:long,lat:double,lon:double>>, entries array<struct<k:string,v:string>>")
    rows = ways.select("id", "block_id", F.lit(0).cast("long").alias("ts_millis"), "entries", F.col("points.node_id").alias("node_ids"), F.col("points.lat").alias("lats"), F.col("points.lon").alias("lons"))
    made = tables.ways(tables.located_in_file(rows))
    lines = {r.id: r.value.split("\t") for r in sinks.way_lines(tables.way_table(made).join(made.select("id", "block_id"), "id")).collect()}
    assert lines[7][2:6] == ["7", "f", "t", "f"] and lines[7][10:12] == ["{1}", "\\N"]
    assert lines[7][12] == r'"\"Building\"=>\"yes\",\"n\"=>\"a\\\"b\\\\c\n\",\"is.line_non_valid\"=>\"true\""'
    assert lines[8][3:6] == ["t", "f", "f"] and lines[8][10] == "{1,2,1}" and lines[8][12] == "\\N" and float(lines[8][6]) > 70
    assert struct.unpack("<BIII", bytes.fromhex(lines[8][9])[:13]) == (1, 0x20000002, 4326, 3)


@pytest.mark.parametrize("form", ["PARQUET", "ARROW_IPC"])
def test_from_file_to_tables(spark, file, tmp_path, form):
    from terracell import transform

    out = f"{tmp_path}/out-{form}"
    took = transform.main(["-source_pbf", file, "-target", out, "-arrow_format", form, "-preserve_all_nodes"], spark)
    assert took["total"] > 0
    back = (lambda name, schema: spark.read.parquet(f"{out}/arrow/{name}")) if form == "PARQUET" else (lambda name, schema: sinks.read_arrow(spark, f"{out}/arrow/{name}", schema))
    ways = transform.read(spark, file).ways
    schema = tables.way_table(ways).schema.simpleString().removeprefix("struct<").removesuffix(">")
    way = back("ways", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables.way_table(ways).schema)).first()
    assert schema and way.id == 77 and way.pointIdxs == [10, 7, 10] and way.closed and way.tags == {"name": "Café"}
    assert way.latitude == pytest.approx(-5e-6) and way.scale > 0 and (way.bboxMinX, way.bboxMaxY) == pytest.approx((-3e-5, 1e-5))
    nodes = back("nodes", "id long, h33 smallint, h38 int, latitude double, longitude double, tags map<string,string>")
    assert sorted({r.id for r in nodes.collect()}) == [-3, 7, 10]
    text = spark.read.text(f"{out}/relations/members").collect()
    assert {r.value for r in text} == {'5\t7\tN\t"stop"\t0', "5\t77\tW\t\\N\t1"}
    import glob

    script = open(glob.glob(f"{out}/sql/ways_import_000.sql")[0]).read()
    assert script.startswith("SET application_name = 'psql sql/ways_import_000.sql';") and "ATTACH PARTITION" in script and script.endswith("COMMIT;")
    with pytest.raises(FileExistsError):
        transform.run(spark, file, out)
    skipped = transform.read(spark, file, transform.Options(skip_buildings=True)).nodes
    assert sorted({r.id for r in skipped.collect()}) == [7, 10]  # tagged, or in a relation
    with pytest.raises(ValueError, match="nothing to write"):
        transform.run(spark, file, f"{out}2", transform.Options(result_in_tsv=False))


def test_session_functions(spark):
    from terracell.functions import geometry, session

    session.register(spark)
    row = spark.sql("select to_short_h3_8(590282369378811903) a, to_short_h3_3(to_full_from_short_h3_3(cast(-31636 as smallint))) b, to_ha_arrays_text('1,2') c, to_short_h3_3(null) d, h3_latlng_to_cell(37.3615593D, -122.0553238D, 5) e").first()
    assert (row.a, row.b, row.c, row.d, row.e) == (296419327, -31636, "1|2", None, 0x85283473FFFFFFF)
    row = spark.sql("select size(h3_grid_disk(599686042433355775, 2)) n, h3_grid_path(599686042433355775, 599686042433355775) p, geo_geodesic_m(0D, 1D) m").first()
    assert row.n == 19 and row.p == [599686042433355775] and abs(row.m - geometry.MAJOR * 3.141592653589793 / 180) < 1e-6
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:
        line = spark.range(1).select(geometry.line_wkb(F.expr("array(named_struct('lat', 1D, 'lon', 2D), named_struct('lat', 3D, 'lon', 4D))")).alias("w"))
        assert line.select(F.call_function("st_srid", session.geometry_type(F.col("w")))).first()[0] == 4326
    finally:
        spark.conf.unset("spark.sql.geospatial.enabled")


def test_exported_areas_are_read(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('0101\trelation\t4\t"a"=>"b"\n00\tway\t5\t\\N\n')
    assert [tuple(r) for r in sinks.areas(sinks.read_exported(spark, str(tmp_path / "a.tsv"))).collect()] == [(4, bytearray(b"\x01\x01"), '{"a":"b"}')]


def test_catalogued(spark, tmp_path):
    rows = spark.createDataFrame([(2, 1, "a"), (1, 1, None)], "id long, h33 int, t string")
    spark.sql("drop table if exists terracell_t")
    try:
        sinks.catalogued(rows, "terracell_t", comments={"t": "what it's named"}, not_null=("id",))
        assert spark.table("terracell_t").count() == 2
        assert "what it's named" in [r["comment"] for r in spark.sql("describe terracell_t").collect()]
        with pytest.raises(ValueError, match="nulls"):
            sinks.catalogued(rows, "terracell_u", not_null=("t",))
    finally:
        spark.sql("drop table if exists terracell_t")
