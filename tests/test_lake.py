"""Staging to gold on the hand-written squads, with answers worked out by hand."""

import json
from statistics import correlation

import pytest

from squadlake import fixed_values, sources
from squadlake.plans import (
    GOLD_TABLES,
    Floors,
    Lake,
    bronze_coverage,
    lake_quality,
    presentation,
    run_bronze,
    run_gold,
    run_silver,
)
from squadlake.sources import schemas
from tests.squad_files import ANN, BO, CY, SQUADS, player, write_staging

M = 1_000_000


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = Lake(str(root / "tables"))
    run_bronze(spark, write_staging(root), lake)
    run_silver(spark, lake)
    run_gold(spark, lake)
    return lake


def rows(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def read(spark, lake, group, name, *columns):
    return rows(presentation(spark, lake, group, name), *columns)


def test_bronze_keeps_every_document(spark, lake):
    bronze = sources.scan_bronze(spark, lake.bronze)
    assert bronze.count() == len(SQUADS) + 1
    corrupt = bronze.where("_corrupt_record is not null")
    assert rows(corrupt, "team", "season") == [("AFC_Mill", 2013)]
    assert ("Salt & Sand", 2014) in rows(bronze, "team", "season")
    assert bronze.where("source_file like '%/Salt & Sand_9_2014.json'").count() == 1


def test_indented_document_is_read_whole(spark, lake):
    flat = sources.scan_players_flat(spark, lake.players_flat)
    assert flat.where("team = 'Harbour_FC' and season = 2010").count() == 9
    assert dict(flat.dtypes)["players_nationality"] == "array<string>"


def test_coverage(spark, lake):
    report = bronze_coverage(sources.scan_bronze(spark, lake.bronze))
    seasons = [2004, 2005, 2009, 2010, 2011, 2012, 2013, 2014]
    present = {
        "Harbour_FC": [2004, 2005, 2010, 2011, 2013],
        "FC_Quay": [2009, 2010, 2011],
        "North_Vale": [2010, 2011, 2012],
        "AFC_Mill": [2012, 2013],
        "Salt & Sand": [2014],
    }
    files = {"Harbour_FC": 6, "FC_Quay": 3, "North_Vale": 3, "AFC_Mill": 2, "Salt & Sand": 1}
    got = {r.team: (r.files, r.seasons_present, r.seasons_missing) for r in report.collect()}
    assert got == {
        team: (files[team], years, [s for s in seasons if s not in years])
        for team, years in present.items()
    }


def test_quality_report(spark, lake):
    report = lake_quality(spark, lake)
    names = ("rows_in", "rows_out", "rejected", "duplicate_files", "empty_squads")
    got = {(r.layer, r.team, r.season): tuple(r[n] for n in names) for r in report.collect()}
    assert got["bronze", "Harbour_FC", 2011] == (2, 2, 0, 1, 0)
    assert got["bronze", "North_Vale", 2011] == (1, 1, 0, 0, 1)
    assert got["bronze", "North_Vale", 2012] == (1, 1, 0, 0, 1)
    assert got["bronze", "AFC_Mill", 2013] == (1, 0, 1, 0, 0)
    assert got["silver", "Harbour_FC", 2010] == (9, 2, 7, 0, 0)
    assert got["silver", "Salt & Sand", 2014] == (12, 12, 0, 0, 0)


def test_quarantine_names_every_broken_rule(spark, lake):
    quarantine = sources.scan_quarantine(spark, lake.quarantine)
    assert dict(rows(quarantine, "players_id", "reject_reason")) == {
        "r1": "market_value", "r2": "market_value", "r3": "height", "r4": "foot", "r5": "foot",
        "r6": "market_value", "r7": "height,market_value",
    }


def test_clean_rows(spark, lake):
    players = sources.scan_players(spark, lake.players)
    assert players.count() == 28
    squad = sources.lookup_team_season(players, "Harbour_FC", 2010).drop("team", "season")
    assert sorted(map(tuple, squad.collect())) == [
        ("h1", "Ann One", "Keeper", 26, 180, "Left", "No team", 4 * M, "Available to play", "X", "Y"),
        ("h2", "Bo Two", "Back", 35, 180, "Right", "No team", 2 * M, "Injuried", "None", "None"),
    ]
    quay = sources.lookup_team_season(players, "Quay", 2010)
    columns = ("players_id", "players_signedFrom", "player_first_nationality", "player_second_nationality")
    assert sorted(rows(quay, *columns)) == [("q1", "Club B", "Z", "None"), ("q2", "Club B", "None", "None")]
    assert rows(players.where("players_id = 'q3'"), "players_marketValue") == [(3_000 * M,)]
    ages = sorted(rows(players.where("season = 2014"), "players_id", "players_age"))
    assert [age for _, age in ages] == [19, 20, 23, 24, 27, 28, 31, 32, None, None, 19, None]


def test_season_ranking(spark, lake):
    got = read(spark, lake, "valuable_players", "season_ranking", "season", "players_id", "rank")
    by_season = {}
    for season, key, rank in got:
        by_season.setdefault(season, []).append((key, rank))
    expected = {
        2010: ["q1", "z1", "h1", "h2", "q2"],
        2011: ["h1", "x9", "q2"],
        2012: ["m1"],
        2013: ["h3", "h1"],
        2014: [f"s{i:02d}" for i in range(1, 11)],
    }
    assert by_season == {
        season: [(key, i + 1) for i, key in enumerate(keys)] for season, keys in expected.items()
    }


def test_overall_ranking(spark, lake):
    got = read(spark, lake, "valuable_players", "overall_ranking", "players_id", "max_value", "rank")
    keys = [f"s{i:02d}" for i in range(1, 13)] + ["h3", "m1", "q1"]
    values = [20, 19, 18, 17, 16, 15, 14, 13, 10, 10, 10, 10, 9, 7, 6]
    assert got == [(k, v * M, i + 1) for i, (k, v) in enumerate(zip(keys, values))]


def test_namesakes_merge_only_when_the_name_is_the_entity(spark, lake, tmp_path):
    from squadlake.operators import max_per_entity

    players = sources.scan_players(spark, lake.players)
    both = max_per_entity(players, ["players_id", "players_name"], "players_marketValue")
    assert sorted(rows(both.where("players_name = 'Sam Twin'"), "players_id", "max_value")) == [
        ("q2", 3 * M), ("x9", 4 * M),
    ]
    merged = max_per_entity(players, ["players_name"], "players_marketValue")
    assert rows(merged.where("players_name = 'Sam Twin'"), "max_value") == [(4 * M,)]


def test_age_correlation(spark, lake):
    got = read(spark, lake, "market_correlations", "age_correlation", "*")
    ages = [19, 20, 23, 24, 27, 28, 31, 32, 19]
    values = [20, 19, 18, 17, 16, 15, 14, 13, 10]
    assert [row[0] for row in got] == [2010, 2011, 2012, 2013, 2014]
    assert [row[1] for row in got] == [
        pytest.approx(correlation([26, 35, 26, 19, 31], [4, 2, 6, 2, 6])),
        pytest.approx(correlation([27, 24, 20], [5, 4, 3])),
        None,
        None,
        pytest.approx(correlation(ages, values)),
    ]
    assert [row[2] for row in got] == [4 * M, 4 * M, 7 * M, 6 * M, pytest.approx(172 * M / 12)]


def test_position_analysis(spark, lake):
    got = read(spark, lake, "market_correlations", "position_analysis", "*")
    assert [row[0] for row in got] == sorted(row[0] for row in got)
    assert sorted(got) == [
        (2010, "Back", 4 * M, 2), (2010, "Keeper", 4 * M, 1), (2010, "Wing", 4 * M, 2),
        (2011, "Keeper", 5 * M, 1), (2011, "Wing", 3.5 * M, 2), (2012, "Keeper", 7 * M, 1),
        (2013, "Back", 9 * M, 1), (2013, "Keeper", 3 * M, 1),
        (2014, "Wing", pytest.approx(172 * M / 12), 12),
    ]
    assert [row for row in got if row[0] == 2013][0][1] == "Back"


def test_age_groups_analysis(spark, lake):
    assert read(spark, lake, "market_correlations", "age_groups_analysis", "*") == [
        (2010, "Under 20", 2 * M, 1), (2010, "24-27", 5 * M, 2), (2010, "28-31", 6 * M, 1),
        (2010, "Over 31", 2 * M, 1), (2011, "20-23", 3 * M, 1), (2011, "24-27", 4.5 * M, 2),
        (2012, "28-31", 7 * M, 1), (2013, "28-31", 6 * M, 2), (2014, "Under 20", 15 * M, 2),
        (2014, "20-23", 18.5 * M, 2), (2014, "24-27", 16.5 * M, 2), (2014, "28-31", 14.5 * M, 2),
        (2014, "Over 31", 10.75 * M, 4),
    ]


def test_team_injuries(spark, lake):
    got = read(spark, lake, "injury_analysis", "team_injuries", "*")
    assert got[0] == (2010, "Harbour", 2, 1, 50.0)
    assert sorted(got) == [
        (2010, "Harbour", 2, 1, 50.0), (2010, "North Vale", 1, 0, 0.0), (2010, "Quay", 2, 0, 0.0),
        (2011, "Harbour", 2, 0, 0.0), (2011, "Quay", 1, 1, 100.0), (2012, "AFC Mill", 1, 0, 0.0),
        (2013, "Harbour", 2, 0, 0.0), (2014, "Salt & Sand", 12, 2, 16.67),
    ]


def test_position_injuries(spark, lake):
    assert sorted(read(spark, lake, "injury_analysis", "position_injuries", "*")) == [
        (2010, "Back", 2, 1, 50.0), (2010, "Keeper", 1, 0, 0.0), (2010, "Wing", 2, 0, 0.0),
        (2011, "Keeper", 1, 0, 0.0), (2011, "Wing", 2, 1, 50.0), (2012, "Keeper", 1, 0, 0.0),
        (2013, "Back", 1, 0, 0.0), (2013, "Keeper", 1, 0, 0.0), (2014, "Wing", 12, 2, 16.67),
    ]


def test_squad_ages(spark, lake):
    assert read(spark, lake, "squad_age_analysis", "team_age_evolution", "*") == [
        ("AFC Mill", 2012, 28.0), ("Harbour", 2005, 25.5), ("Harbour", 2010, 30.5),
        ("Harbour", 2011, 25.5), ("Harbour", 2013, 29.0), ("North Vale", 2010, 31.0),
        ("Quay", 2009, 25.0), ("Quay", 2010, 22.5), ("Quay", 2011, 20.0),
        ("Salt & Sand", 2014, 24.78),
    ]
    assert read(spark, lake, "squad_age_analysis", "season_age_evolution", "*") == [
        (2005, 25.5), (2009, 25.0), (2010, 27.4), (2011, 23.67), (2012, 28.0), (2013, 29.0),
        (2014, 24.78),
    ]
    assert read(spark, lake, "squad_age_analysis", "team_age_stats", "*") == [
        ("North Vale", 31.0, 31, 31), ("AFC Mill", 28.0, 28, 28), ("Harbour", 27.63, 21, 35),
        ("Salt & Sand", 24.78, 19, 32), ("Quay", 23.0, 19, 26),
    ]


def test_yearly_evolution(spark, lake):
    columns = ("team", "season", "total_value", "squad_size", "previous_value", "yoy_growth",
               "avg_player_value", "season_gap")
    assert read(spark, lake, "market_evolution", "yearly_evolution", *columns) == [
        ("AFC Mill", 2012, 7 * M, 1, None, None, 7.0 * M, None),
        ("Harbour", 2010, 6 * M, 2, None, None, 3.0 * M, None),
        ("Harbour", 2011, 9 * M, 2, 6 * M, 50.0, 4.5 * M, 1),
        ("Harbour", 2013, 12 * M, 2, 9 * M, pytest.approx(100 / 3), 6.0 * M, 2),
        ("North Vale", 2010, 6 * M, 1, None, None, 6.0 * M, None),
        ("Quay", 2010, 8 * M, 2, None, None, 4.0 * M, None),
        ("Quay", 2011, 3 * M, 1, 8 * M, -62.5, 3.0 * M, 1),
        ("Salt & Sand", 2014, 172 * M, 12, None, None, 14333333.33, None),
    ]


def test_total_growth(spark, lake):
    got = read(spark, lake, "market_evolution", "total_growth", "*")
    assert got[0] == ("Harbour", 2010, 2013, 6 * M, 12 * M, 100.0)
    assert got[-1] == ("Quay", 2010, 2011, 8 * M, 3 * M, -62.5)
    assert {row[0]: row[5] for row in got[1:-1]} == {"AFC Mill": 0, "North Vale": 0, "Salt & Sand": 0}


GOLD_SCHEMAS = {
    "season_ranking": "players_id string, players_name string, team string, season int,"
    " players_marketValue bigint, rank int",
    "overall_ranking": "players_id string, players_name string, max_value bigint, rank int",
    "age_correlation": "season int, age_value_correlation double, avg_market_value double",
    "position_analysis": "season int, players_position string, avg_value double, player_count bigint",
    "age_groups_analysis": "season int, age_group string, avg_value double, player_count bigint",
    "team_injuries": "season int, team string, total_players bigint, injured_players bigint,"
    " injury_rate double",
    "position_injuries": "season int, players_position string, total_players bigint,"
    " injured_players bigint, injury_rate double",
    "team_age_evolution": "team string, season int, avg_squad_age double",
    "season_age_evolution": "season int, avg_season_age double",
    "team_age_stats": "team string, overall_avg_age double, min_age int, max_age int",
    "yearly_evolution": "season int, team string, total_value bigint, squad_size bigint,"
    " previous_value bigint, yoy_growth double, avg_player_value double, season_gap int",
    "total_growth": "team string, start_season int, end_season int, initial_value bigint,"
    " final_value bigint, total_growth_percent double",
}


@pytest.mark.parametrize("table", GOLD_TABLES, ids=lambda table: table.name)
def test_gold_schema(spark, lake, table):
    stored = sources.read_gold_table(spark, lake.gold, table.group, table.name)
    expected = spark.createDataFrame([], GOLD_SCHEMAS[table.name])
    assert sorted(stored.dtypes) == sorted(expected.dtypes)


def test_layer_schemas(spark, lake):
    for scan, schema in (
        (sources.scan_bronze(spark, lake.bronze), schemas.BRONZE),
        (sources.read_table(spark, lake.layer("silver"), "players_flat"), schemas.PLAYER_FLAT),
        (sources.read_table(spark, lake.layer("silver"), "players"), schemas.PLAYER_CLEAN),
    ):
        assert sorted(scan.dtypes) == sorted(spark.createDataFrame([], schema).dtypes)


def test_running_a_layer_twice_gives_the_same_rows(spark, lake, tmp_path):
    staging = write_staging(tmp_path)
    again = Lake(str(tmp_path / "tables"))
    for _ in range(2):
        run_bronze(spark, staging, again)
        run_silver(spark, again)
    first = sources.scan_players(spark, lake.players)
    second = sources.scan_players(spark, again.players)
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_rows_in_are_rows_out_and_rejected(spark, lake):
    flat = sources.scan_players_flat(spark, lake.players_flat).count()
    kept = sources.scan_players(spark, lake.players).count()
    rejected = sources.scan_quarantine(spark, lake.quarantine).count()
    assert flat == kept + rejected == 35


def test_floors_and_entity_are_parameters(spark, lake, tmp_path):
    import shutil

    other = Lake(str(tmp_path / "tables"))
    shutil.copytree(lake.layer("silver"), other.layer("silver"))
    run_gold(spark, other, Floors(market=2013, age=2014), entity=("players_name",))
    ages = presentation(spark, other, "squad_age_analysis", "season_age_evolution")
    assert rows(ages, "season") == [(2014,)]
    ranking = presentation(spark, other, "valuable_players", "season_ranking")
    assert {row[0] for row in rows(ranking, "season")} == {2013, 2014}
    assert "players_id" not in ranking.columns


def test_command_line_builds_and_publishes_the_same_lake(spark, lake, tmp_path):
    from squadlake.__main__ import main

    staging, copy = write_staging(tmp_path), Lake(str(tmp_path / "copy"))
    main(["--staging", staging, "--lake", str(tmp_path / "lake"), "--publish", copy.root])
    for table in GOLD_TABLES:
        left = presentation(spark, lake, table.group, table.name)
        right = presentation(spark, copy, table.group, table.name)
        assert left.dtypes == right.dtypes
        assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
    published = sources.scan_players(spark, copy.players)
    assert published.exceptAll(sources.scan_players(spark, lake.players)).isEmpty()
    assert sources.scan_quarantine(spark, copy.quarantine).count() == 7


def test_an_error_in_one_table_ends_the_run(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_gold(spark, Lake(str(tmp_path)))


def test_players_of_a_damaged_document_are_rejected_for_it(spark, tmp_path):
    """A field of the wrong type: Spark gives the rest of the document, the counts and tables agree."""
    from squadlake.plans import lake_quality, run_reports

    folder = tmp_path / "in" / "Season_2011"
    folder.mkdir(parents=True)
    players = json.dumps([player("a", *ANN, "20", "€1m", nationality="X"), player("b", *BO, "20", "€1m")])
    (folder / "Quay_1_2011.json").write_text(f'{{"id": "1", "players": {players}}}', encoding="utf-8")
    good = json.dumps([player("c", *CY, "20", "€1m")])
    (folder / "Mill_1_2011.json").write_text(f'{{"id": "2", "players": {good}}}', encoding="utf-8")
    lake = Lake(str(tmp_path / "lake"))
    run_bronze(spark, str(tmp_path / "in"), lake)
    assert [r.players_id for r in run_silver(spark, lake).collect()] == ["c"]
    reasons = sources.scan_quarantine(spark, lake.quarantine).select("players_id", "reject_reason").collect()
    assert {r.reject_reason for r in reasons} <= {"document"}
    counts = {(r.layer, r.team): (r.rows_in, r.rows_out, r.rejected) for r in lake_quality(spark, lake).collect()}
    assert counts["bronze", "Quay"] == (1, 0, 1) and counts["silver", "Mill"] == (1, 1, 0)
    assert counts.get(("silver", "Quay"), (0, 0, 0))[1] == 0
    run_reports(spark, lake)
    totals = sources.read_table(spark, lake.layer("reports"), "run_totals").first()
    assert (totals.teams, totals.files, totals.present, totals.missing) == (2, 2, 2, 0)
    assert sources.read_table(spark, lake.layer("reports"), "coverage").count() == 2
    assert sources.read_table(spark, lake.layer("reports"), "quality").count() >= 2


def test_age_groups_are_read_by_age(spark, lake):
    groups = [r[0] for r in read(spark, lake, "market_correlations", "age_groups_analysis", "age_group")]
    labels = [name for name, _, _ in fixed_values.AGE_BANDS]
    orders = [labels.index(g) if g in labels else len(labels) for g in groups if g]
    seasons = [r[0] for r in read(spark, lake, "market_correlations", "age_groups_analysis", "season")]
    assert list(zip(seasons, orders)) == sorted(zip(seasons, orders))
