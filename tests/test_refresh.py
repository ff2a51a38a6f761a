"""Runs over changed seasons, and published copies."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from squadlake import operators as ops
from squadlake import sources
from squadlake.plans import GOLD_TABLES, Lake, lake_quality, publish_lake, refresh, run_lake, written_rows
from squadlake.plans.publish import layer_tables
from squadlake.plans.silver import CountsDiffer
from squadlake.sources import publishing, schemas
from tests.squad_files import player, write_staging

BRONZE_SCHEMA, CLEAN = schemas.BRONZE, schemas.PLAYER_CLEAN


def contents(spark, lake):
    """Every table of a lake, as sorted text."""
    found = {}
    for layer, tables in layer_tables().items():
        for table in tables:
            rows = sources.read_table(spark, lake.layer(layer), table.name, table.schema)
            found[layer, table.name] = sorted(json.dumps(r, default=str) for r in map(as_plain, rows.select(*sorted(rows.columns)).collect()))
    for name in ("quality", "coverage", "run_totals", "files"):
        rows = sources.read_table(spark, lake.layer("reports"), name)
        found["reports", name] = sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
    return found


def as_plain(row):
    return row.asDict(recursive=True)


def versions(spark, lake):
    return {layer: sources.current_version(spark, lake.layer(layer)).number for layer in ("bronze", "silver", "gold", "reports", "state")}


def put(staging, name, *players):
    file = Path(staging) / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(json.dumps({"id": "n", "updatedAt": "t", "players": list(players)}), encoding="utf-8")


@pytest.fixture
def staged(tmp_path):
    return write_staging(tmp_path)


def rebuilt(spark, staged, tmp_path, name="fresh"):
    fresh = Lake(str(tmp_path / name))
    run_lake(spark, staged, fresh)
    return contents(spark, fresh)


def test_a_refresh_rewrites_the_seasons_that_changed(spark, staged, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    assert run_lake(spark, staged, lake) is None
    assert run_lake(spark, staged, lake, refresh=True) == []
    assert set(versions(spark, lake).values()) == {1}

    put(staged, "Season_2012/FC_Quay_5_2012.json", player("q9", "New One", "Back", "22", "€8.00m"))
    assert run_lake(spark, staged, lake, refresh=True) == [2012]
    for layer, table in (("bronze", "squads"), ("silver", "players_flat"), ("silver", "players"), ("gold", "subtotals/team")):
        parts = sources.current_version(spark, lake.layer(layer)).tables[table]
        assert [(part.only, part.without) for part in parts] == [(("2012",), ()), (None, ("2012",))], table
        written = Path(lake.layer(layer), table, f"_write={parts[0].write}")
        assert [d.name for d in written.glob("season=*")] == ["season=2012"]
    assert contents(spark, lake) == rebuilt(spark, staged, tmp_path, "one")

    put(staged, "Season_2011/Harbour_FC_1_2011.json", player("h1", "Ann One", "Keeper", "27", "€50.00m"))  # changed
    (Path(staged) / "Season_2014" / "Salt & Sand_9_2014.json").unlink()  # the only file of its season
    put(staged, "Odd/North_Vale_7_x.json", player("z2", "No Season", "Back", "30", "€1m"))  # no season at all
    assert sorted(run_lake(spark, staged, lake, refresh=True), key=str) == [2011, 2014, None]
    assert contents(spark, lake) == rebuilt(spark, staged, tmp_path, "two")
    assert 2014 not in {r.season for r in sources.scan_players(spark, lake.players).collect()}


def test_a_refresh_that_fails_is_done_again(spark, staged, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    run_lake(spark, staged, lake)
    before = contents(spark, lake)
    put(staged, "Season_2013/FC_Quay_5_2013.json", player("q9", "New One", "Back", "22", "€8.00m"))

    def fails(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(refresh, "run_gold", fails)
        with pytest.raises(RuntimeError, match="lost"):
            run_lake(spark, staged, lake, refresh=True)
    after = contents(spark, lake)
    assert {key for key in after if after[key] != before[key]} == {
        ("bronze", "squads"), ("silver", "players_flat"), ("silver", "players"),
    }
    put(staged, "Season_2004/FC_Quay_5_2004.json", player("q8", "Old One", "Back", "22", "€8.00m"))
    assert sorted(run_lake(spark, staged, lake, refresh=True)) == [2004, 2013]
    assert contents(spark, lake) == rebuilt(spark, staged, tmp_path)


def test_files_of_other_seasons_are_not_opened(spark, staged):
    rows = sources.scan_squad_json(spark, staged, seasons=[2010])
    assert {r.season for r in rows.collect()} == {2010}
    plan = rows._jdf.queryExecution().executedPlan()
    plan.execute().count()
    scan = plan
    while scan.children().size():
        scan = scan.children().head()
    assert scan.metrics().apply("numFiles").value() == 3


def test_listings_are_compared_by_path_length_and_time(spark):
    def listing(**files):
        rows = [(path, length, time, 2010) for path, (length, time) in files.items()]
        return spark.createDataFrame(rows, "path string, length bigint, modified string, season int").withColumn(
            "modified", F.col("modified").cast("timestamp")
        )

    one, two = "2024-01-01 00:00:00", "2024-01-01 00:00:01"
    now = listing(same=(1, one), longer=(2, one), later=(1, two), new=(1, one))
    before = listing(same=(1, one), longer=(1, one), later=(1, one), deleted=(1, one))
    found = {r.path: (r.change, r.season) for r in sources.changed_files(now, before).collect()}
    assert found == {
        "longer": ("changed", 2010), "later": ("changed", 2010), "new": ("new", 2010), "deleted": ("deleted", 2010),
    }


def test_counts_of_the_writes_are_those_of_the_reports(spark, staged, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    run_lake(spark, staged, lake)
    written = {(r.layer, r["table"], r.counted): r.rows for r in written_rows(spark, lake).collect()}
    totals = lake_quality(spark, lake).groupBy("layer").agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "rejected")])
    for row in totals.collect():
        table = "squads" if row.layer == "bronze" else "players_flat"
        assert [written[row.layer, table, c] for c in ("rows_in", "rows_out", "rejected")] == [row.rows_in, row.rows_out, row.rejected]
    assert written["silver", "players", "rows"] == 28 and written["silver", "quarantine", "rows"] == 7
    stored = sources.read_table(spark, lake.layer("reports"), "written_rows")
    assert sorted(map(str, stored.collect())) == sorted(map(str, written_rows(spark, lake).select(stored.columns).collect()))


def test_silver_is_not_committed_if_rows_are_lost(spark, staged, tmp_path, monkeypatch):
    from squadlake.plans import silver

    lake = Lake(str(tmp_path / "lake"))
    run_lake(spark, staged, lake)
    before = versions(spark, lake)
    monkeypatch.setattr(silver, "rejected_players", lambda flat: flat.limit(0))
    with pytest.raises(CountsDiffer):
        silver.run_silver(spark, lake)
    assert versions(spark, lake) == before


def test_publishing_copies_what_differs(spark, staged, tmp_path):
    lake, copy = Lake(str(tmp_path / "lake")), Lake(str(tmp_path / "copy"))
    run_lake(spark, staged, lake)
    publish_lake(spark, lake, copy)
    numbers = {layer: sources.current_version(spark, copy.layer(layer)).number for layer in layer_tables()}
    publish_lake(spark, lake, copy)
    assert numbers == {layer: sources.current_version(spark, copy.layer(layer)).number for layer in layer_tables()}

    put(staged, "Season_2012/FC_Quay_5_2012.json", player("q9", "New One", "Back", "22", "€8.00m"))
    (Path(staged) / "Season_2014" / "Salt & Sand_9_2014.json").unlink()
    run_lake(spark, staged, lake, refresh=True)
    report = sources.publish_tables(spark, lake.layer("silver"), copy.layer("silver"), layer_tables()["silver"])
    assert {(r["table"], r.partition) for r in report.collect() if r.copied} == {("players", "2012"), ("players_flat", "2012")}
    publish_lake(spark, lake, copy)
    for layer, tables in layer_tables().items():
        for table in tables:
            left, right = (sources.read_table(spark, place.layer(layer), table.name, table.schema) for place in (lake, copy))
            assert left.exceptAll(right.select(left.columns)).isEmpty() and right.select(left.columns).exceptAll(left).isEmpty()
            assert ops.fingerprints(left).first() == ops.fingerprints(right).first()


def test_a_copy_that_differs_is_not_committed(spark, tmp_path, monkeypatch):
    source, copy = str(tmp_path / "source"), str(tmp_path / "copy")
    rows = spark.createDataFrame([("A", 2010, 1), ("B", 2011, 2)], "team string, season int, v int")
    table = [sources.Table("t", "team string, v int, season int")]
    sources.replace_table(rows, source, "t")
    sources.publish_tables(spark, source, copy, table)
    sources.replace_table(rows.withColumn("v", F.col("v") + 1), source, "t")
    with monkeypatch.context() as patched:
        patched.setattr(publishing, "_in", lambda rows, by, partitions: rows.where("season <> 2011"))
        with pytest.raises(sources.CopyDiffers):
            sources.publish_tables(spark, source, copy, table)
    assert {r.v for r in sources.read_table(spark, copy, "t", table[0].schema).collect()} == {1, 2}
    sources.publish_tables(spark, source, copy, table)
    assert {r.v for r in sources.read_table(spark, copy, "t", table[0].schema).collect()} == {2, 3}


def test_verifying_finds_and_mends_damage(spark, tmp_path):
    source, copy = str(tmp_path / "source"), str(tmp_path / "copy")
    rows = spark.createDataFrame([("A", 2010, 1), ("B", 2011, 2), ("C", None, 3)], "team string, season int, v int")
    table = [sources.Table("t", "team string, v int, season int")]
    sources.replace_table(rows, source, "t")
    sources.publish_tables(spark, source, copy, table)
    [file] = Path(copy).glob("t/_write=*/season=2011/*.parquet")
    file.unlink()
    spark.catalog.clearCache()
    assert not any(r.copied for r in sources.publish_tables(spark, source, copy, table).collect())
    report = sources.publish_tables(spark, source, copy, table, verify=True)
    assert [r.partition for r in report.collect() if r.copied] == ["2011"]
    assert {r.v for r in sources.read_table(spark, copy, "t", table[0].schema).collect()} == {1, 2, 3}


def test_fingerprints_tell_nulls_places_and_repeats_apart(spark):
    schema = "a string, b string, c array<string>"

    def mark(*rows):
        return tuple(ops.fingerprints(spark.createDataFrame(list(rows), schema)).first())

    one, two = ("x", None, ["p", None]), (None, "y", [])
    assert mark(one, two) == mark(two, one)
    different = [
        mark(one), mark(one, one), mark((None, "x", ["p", None])), mark(("x", None, [None, "p"])),
        mark(("x", None, None)), mark(("x", None, [])), mark(("x", "", ["p", None])),
    ]
    assert len(set(different)) == len(different)
    reordered = spark.createDataFrame([one], schema).select("c", "a", "b")
    assert tuple(ops.fingerprints(reordered).first()) == mark(one)
    assert ops.fingerprints(spark.createDataFrame([], schema), ["a"]).count() == 0


def test_gold_tables_all_have_a_place(spark):
    assert len(layer_tables()["gold"]) == len(GOLD_TABLES) == 12
