"""Documents cut at their braces, in files that many tasks read."""

import json
import random

import pytest

from squadlake import sources
from squadlake.sources import squads

TEXTS = ["}", "{", "\\", '"', '\\"', "}\n{", '"}', "\\\\", "a\\", "Ünï 漢 🙂", "][", ",", '{"id": "x"}', "", "plain words " * 5]
LIMIT = "spark.sql.files.maxPartitionBytes"


def document(rng, key):
    players = [{"id": str(i), "name": "".join(rng.choices(TEXTS, k=3))} for i in range(rng.randint(0, 6))]
    return {"id": str(key), "updatedAt": "".join(rng.choices(TEXTS, k=2)), "players": players}


@pytest.fixture(params=[7, 64, 1_000, 1 << 27])
def range_bytes(spark, request):
    before = {name: spark.conf.get(name) for name in (LIMIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set(LIMIT, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def put(tmp_path, **texts):
    folder = tmp_path / "Season_2001"
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}_1_2001.json").write_bytes(text.encode())
    return str(tmp_path)


def found(spark, path, layout="sequence"):
    rows = sources.scan_squad_json(spark, path, layout).collect()
    good = [(r.team, r.id, r.updatedAt, [(p.id, p.name) for p in r.players]) for r in rows if r._corrupt_record is None]
    return sorted(good), sorted((r.team, r._corrupt_record) for r in rows if r._corrupt_record is not None)


def expected(team, documents):
    return [(team, d["id"], d["updatedAt"], [(p["id"], p["name"]) for p in d["players"]]) for d in documents]


def test_every_shape_in_ranges_of_any_size(spark, tmp_path, range_bytes):
    rng = random.Random(range_bytes)
    documents = {team: [document(rng, i) for i in range(12)] for team in ("Lines", "Dense", "Indented", "List", "Mark", "Alone")}
    documents["Alone"] = documents["Alone"][:1]

    def text(team, indent=None):
        return [json.dumps(d, ensure_ascii=team == "Dense", indent=indent) for d in documents[team]]

    path = put(
        tmp_path,
        Lines="\n" + "\r\n".join(text("Lines")) + "\n\n",
        Dense="".join(text("Dense")),
        Indented="\n".join(text("Indented", 2)),
        List="[" + ",\n ".join(text("List")) + "]\n",
        Mark="﻿" + " ".join(text("Mark")),
        Alone=text("Alone", 1)[0],
        Nothing=" \n",
        Empty="",
    )
    good, bad = found(spark, path)
    assert bad == []
    assert good == sorted(row for team, each in documents.items() for row in expected(team, each))
    if range_bytes == 7:
        scan = sources.scan_squad_json(spark, path, "sequence")
        assert spark.read.option("recursiveFileLookup", True).text(path, lineSep="}").rdd.getNumPartitions() > 100
        assert "Python" not in scan._jdf.queryExecution().toString()


def test_the_lines_layout_gives_the_same_rows(spark, tmp_path, range_bytes):
    rng = random.Random(1)
    path = put(tmp_path, A="\n".join(json.dumps(document(rng, i)) for i in range(40)))
    assert found(spark, path, "sequence") == found(spark, path, "lines")


ONE, TWO = ('{"id": "1", "updatedAt": "t", "players": []}', '{"id": "2", "updatedAt": "t", "players": []}')
BROKEN = {
    "beside": (f"{ONE} rubbish {TWO}\n more", ["1", "2"], ["more", "rubbish"]),
    "truncated": ('{"id": "3"', [], ['{"id": "3"']),
    "cut_in_players": (f'{ONE}\n{{"id": "3", "players": [{{', ["1"], ['{"id": "3", "players": [{']),
    "cut_in_text": (f'{ONE}\n{{"id": "3", "updatedAt": "t', ["1"], ['{"id": "3", "updatedAt": "t']),
    "first_line_broken": (f'{{"id": "9", "players": [{{\n{ONE}\n{TWO}', ["1", "2"], ['{"id": "9", "players": [{']),
    "one_brace_more": (f"}}\n{ONE}\n{TWO}", ["1", "2"], ["}"]),
    "no_json": (f'{ONE}{{"id": nonsense}}', ["1"], ['{"id": nonsense}']),
    "only_rubbish": ("rubbish", [], ["rubbish"]),
}


@pytest.mark.parametrize("name", BROKEN)
def test_nothing_is_lost_beside_documents(spark, tmp_path, range_bytes, name):
    text, ids, corrupt = BROKEN[name]
    good, bad = found(spark, put(tmp_path, A=text, Good=TWO))
    assert [row[1] for row in good if row[0] == "A"] == ids
    assert [text for team, text in bad if team == "A"] == corrupt
    assert [row[1] for row in good if row[0] == "Good"] == ["2"]


@pytest.mark.parametrize("layout", ["auto", "document"])
def test_large_files_of_any_layout_are_split(spark, tmp_path, monkeypatch, layout):
    rng = random.Random(3)
    small, large = [document(rng, 1)], [document(rng, i) for i in range(30)]
    path = put(tmp_path, Small=json.dumps(small[0]), Large="\n".join(json.dumps(d, indent=1) for d in large))
    whole = found(spark, path, layout)
    monkeypatch.setattr(squads, "WHOLE_FILE", 2_000)
    assert found(spark, path, layout) == whole == (sorted(expected("Small", small) + expected("Large", large)), [])
