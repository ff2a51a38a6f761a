"""Writing and reading: overwrite rules, partition refresh, odd names, JSON layouts."""

import json

import pytest
from pyspark.sql import functions as F

from squadlake import session, sources
from squadlake.sources import schemas
from squadlake.sources import scan_bronze


@pytest.fixture
def table(spark, tmp_path):
    df = spark.createDataFrame(
        [("A", 2010, 1), ("B", 2010, 2), ("A", 2011, 3), ("1899", 2011, 4)],
        "team string, season int, v int",
    )
    path = str(tmp_path / "table")
    sources.write_layer(df, path)
    return path


def stored(spark, path):
    df = spark.read.schema("team string, v int, season int").parquet(path)
    return sorted((r.team, r.season, r.v) for r in df.collect())


@pytest.mark.parametrize("target", ["{}", "{}/", "file:{}", "file://{}", "{}/season=2010", "{}/.."])
def test_overwriting_the_source_is_refused(spark, table, target):
    target = target.format(table)
    df = spark.read.parquet(table)
    with pytest.raises(ValueError, match="refusing"):
        sources.write_parquet_overwrite(df, target, reads=[table])
    assert len(stored(spark, table)) == 4


def test_a_sibling_with_the_same_prefix_is_not_the_source(spark, table):
    sources.write_parquet_overwrite(spark.read.parquet(table), f"{table}_2", reads=[table])
    assert spark.read.parquet(f"{table}_2").count() == 4


def test_refresh_replaces_only_touched_partitions(spark, table):
    fresh = spark.createDataFrame([("C", 2011, 9)], "team string, season int, v int")
    sources.write_layer(fresh, table, only_touched_partitions=True)
    assert stored(spark, table) == [("A", 2010, 1), ("B", 2010, 2), ("C", 2011, 9)]
    sources.write_layer(fresh, table)
    assert stored(spark, table) == [("C", 2011, 9)]


def test_two_level_layout(spark, table, tmp_path):
    target = str(tmp_path / "by_team")
    df = spark.read.schema("team string, v int, season int").parquet(table)
    sources.write_layer(df, target, reads=[table], partition_by=["team", "season"], cluster_by=[])
    assert (tmp_path / "by_team" / "team=1899" / "season=2011").is_dir()
    assert stored(spark, target) == stored(spark, table)


def test_publish_copies_rows_and_partitions(spark, table, tmp_path):
    target = f"file:{tmp_path}/published/table"
    sources.publish_layer(spark, table, target)
    copy = sources.read_table(spark, f"file:{tmp_path}/published", "table", "team string, v int, season int")
    assert sorted((r.team, r.season, r.v) for r in copy.collect()) == stored(spark, table)
    assert list((tmp_path / "published" / "table").glob("_write=*/season=2010"))
    with pytest.raises(ValueError, match="refusing"):
        sources.publish_layer(spark, table, table)


def test_files_are_snappy_and_can_be_bounded(spark, tmp_path):
    import pyarrow.parquet as pq

    target = str(tmp_path / "bounded")
    sources.write_parquet_overwrite(spark.range(100).coalesce(1), target, max_records_per_file=30)
    files = list((tmp_path / "bounded").glob("*.parquet"))
    assert len(files) == 4 and all(".snappy." in file.name for file in files)
    assert pq.ParquetFile(files[0]).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_bronze(spark, str(tmp_path / "nowhere")).count()


def squad(key, *names):
    return {"id": key, "updatedAt": "t", "players": [{"name": name} for name in names]}


def staged(tmp_path, **texts):
    folder = tmp_path / "Season_2001"
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}_1_2001.json").write_text(text, encoding="utf-8")
    return str(tmp_path)


ONE, TWO = json.dumps(squad("1", "a", "b")), json.dumps(squad("2", "c"))


@pytest.mark.parametrize("layout", ["auto", "lines"])
def test_one_document_per_line(spark, tmp_path, layout):
    path = staged(tmp_path, Harbour=f"{ONE}\r\n\n {TWO} \n", Quay=TWO)
    df = sources.scan_squad_json(spark, path, layout)
    got = df.select("team", "season", "id", F.size("players")).collect()
    assert sorted(map(tuple, got)) == [
        ("Harbour", 2001, "1", 2), ("Harbour", 2001, "2", 1), ("Quay", 2001, "2", 1),
    ]


@pytest.mark.parametrize("layout", ["auto", "document"])
def test_one_document_per_file(spark, tmp_path, layout):
    path = staged(tmp_path, A=json.dumps(squad("1", "a"), indent=1), B=TWO, C=f"\n\n{TWO}", D=f"\ufeff{ONE}")
    df = sources.scan_squad_json(spark, path, layout)
    got = df.select("team", "id", "players.name", "_corrupt_record").collect()
    assert sorted((r.team, r.id, *r.name, r[3]) for r in got) == [
        ("A", "1", "a", None), ("B", "2", "c", None), ("C", "2", "c", None),
        ("D", "1", "a", "b", None),
    ]


def test_unreadable_documents_stay_visible(spark, tmp_path):
    path = staged(tmp_path, A=f"{ONE}\nnonsense\n{TWO}", B=" ", C='{"id": "3", "players": [{')
    df = sources.scan_squad_json(spark, path)
    got = sorted((r.team, r.id or "", r._corrupt_record) for r in df.collect())
    assert got == [
        ("A", "", "nonsense"), ("A", "1", None), ("A", "2", None), ("B", "", " "),
        ("C", "", '{"id": "3", "players": [{'),
    ]


def indented(*squads):
    return "\n".join(json.dumps(json.loads(s), indent=2) for s in squads)


THREE = json.dumps(squad("3", "d"))
SHAPES = {
    "blank_first": (f"\n{ONE}\n{TWO}", ["1", "2"], 0),
    "indented": (indented(ONE, TWO), ["1", "2"], 0),
    "array": (f"[{ONE},\n {TWO}]", ["1", "2"], 0),
    "broken_before_comma": ('{"id": "4", "players": [{"name": "x"}\n,{"name": "y"}]}', ["4"], 0),
    "brace_in_text": (f"{ONE}\n" + json.dumps(squad("5", "} {", "}\n{")), ["1", "5"], 0),
    "garbage_after": (f"{ONE} rubbish", [], 1),
    "same_line": (f"{ONE}{TWO}", [], 1),
}


@pytest.mark.parametrize("layout", ["auto", "document"])
@pytest.mark.parametrize("shape", SHAPES)
def test_no_document_is_lost(spark, tmp_path, layout, shape):
    text, ids, corrupt = SHAPES[shape]
    df = sources.scan_squad_json(spark, staged(tmp_path, A=text), layout)
    got = df.select("id", "_corrupt_record", F.size("players")).collect()
    assert sorted(r.id for r in got if r.id) == ids
    assert [r._corrupt_record for r in got if not r.id] == [text] * corrupt


def test_a_broken_line_costs_itself_alone(spark, tmp_path):
    broken = '{"id": "9", "players": [{'
    for layout in ("auto", "lines"):
        folder = tmp_path / layout
        folder.mkdir()
        df = sources.scan_squad_json(spark, staged(folder, A=f"{broken}\n{TWO}\n{THREE}"), layout)
        got = sorted((r.id or "", r._corrupt_record) for r in df.collect())
        assert got == [("", broken), ("2", None), ("3", None)]


def test_two_documents_on_a_line_stay_visible(spark, tmp_path):
    path = staged(tmp_path, A=f"{ONE}{TWO}\n[{TWO},{THREE}]")
    got = sorted((r.id or "", r._corrupt_record) for r in sources.scan_squad_json(spark, path, "lines").collect())
    assert got == [("", ONE + TWO), ("2", None), ("3", None)]


@pytest.mark.parametrize(
    ("one", "other", "same"),
    [
        ("s3a://b/x", "s3://b/x", True),
        ("s3a://b/x", "s3n://b/x/y", True),
        ("s3a://b/x", "s3a://c/x", False),
        ("/a/../a/x", "/a/x", True),
        ("file:/a/x", "/a/./x", True),
        ("file:///a/x", "/a/xy", False),
        ("hdfs://nn:8020/x", "/x", False),
    ],
)
def test_places_are_compared_as_their_stores_name_them(spark, one, other, same):
    assert sources.layers._overlap(spark, one, other) is same


def test_the_default_store_is_the_same_with_and_without_its_name(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://nn:8020")
    try:
        assert sources.layers._overlap(spark, "hdfs://nn:8020/x", "/x/y")
        assert not sources.layers._overlap(spark, "hdfs://other:8020/x", "/x")
    finally:
        conf.set("fs.defaultFS", before)


def test_layout_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown layout"):
        sources.scan_squad_json(spark, str(tmp_path), "other")


def test_unknown_fields_are_ignored_and_missing_ones_are_null(spark, tmp_path):
    folder = tmp_path / "x_1999"
    folder.mkdir()
    (folder / "A_1_1999.json").write_text('{"id": 7, "other": 1, "players": [{"age": 19, "x": 1}]}')
    (folder / "notes.txt").write_text("not a squad")
    row = sources.scan_squad_json(spark, str(tmp_path)).first()
    assert (row.id, row.updatedAt, row.season) == ("7", None, 1999)
    assert row.players[0].age == "19" and row.players[0].name is None


def test_bronze_round_trip_of_odd_team_names(spark, tmp_path):
    for name in ("Salt & Sand_1", "A+B_1", "100%_1", "Ünal_1", "x=y_1"):
        folder = tmp_path / "in" / "Season_2001"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}_2001.json").write_text(json.dumps(squad("1", "a")))
    squads = sources.scan_squad_json(spark, str(tmp_path / "in"))
    sources.write_bronze(squads, str(tmp_path / "out"), partition_by=["team", "season"], cluster_by=[])
    got = spark.read.schema(schemas.BRONZE).parquet(str(tmp_path / "out"))
    assert {r.team for r in got.collect()} == {"Salt & Sand", "A+B", "100%", "Ünal", "x=y"}


def test_shared_folder_prefers_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert folder == named.rstrip("/") if named else session.shared_folder(spark) == folder
