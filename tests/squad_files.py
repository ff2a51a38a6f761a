"""A small staging folder, written by hand."""

import json
from pathlib import Path


def player(key, name, position, age, value, status=None, **other):
    return {
        "id": key, "name": name, "position": position, "dateOfBirth": "Jan 1, 2000", "age": age,
        "nationality": ["X", "Y"], "currentClub": "Club A", "height": "1,80m", "foot": "right",
        "joinedOn": "Jul 1, 2020", "signedFrom": "Club B: fee €1m", "marketValue": value,
        "status": status,
    } | other


ANN, BO, CY, TWIN = ("Ann One", "Keeper"), ("Bo Two", "Back"), ("Cy Three", "Wing"), ("Sam Twin", "Wing")

AGES_2014 = ["19", "20", "23", "24", "27", "28", "31", "32", "", "n/a", " 19 ", "19.5"]
VALUES_2014 = [f"€{m}.00m" for m in (20, 19, 18, 17, 16, 15, 14, 13, 10, 10, 10, 10)]
STATUS_2014 = [None, "", "Team captain", "Available to play", "Injury, team captain", "Calf"]

REJECTED = [
    player("r1", "Rae", "Back", "20", "-"),
    player("r2", "Rae", "Back", "20", "€1.20bn"),
    player("r3", "Rae", "Back", "20", "€1m", height="1.85m"),
    player("r4", "Rae", "Back", "20", "€1m", foot=None),
    player("r5", "Rae", "Back", "20", "€1m", foot=""),
    player("r6", "Rae", "Back", "20", "0"),
    player("r7", "Rae", "Back", "20", "", height=None),
]

SQUADS = {
    "Season_2004/Harbour_FC_11_2004.json": [player("h1", *ANN, "20", "€1.00m")],
    "Season_2005/Harbour_FC_11_2005.json": [
        player("h1", *ANN, "21", "€2.00m"),
        player("h2", *BO, "30", "€1000k", "Knee"),
    ],
    "Season_2009/FC_Quay_5_2009.json": [
        player("q1", *CY, "25", "€5.00m"),
        player("q3", "Big Money", "Wing", "25", "€3000m"),
    ],
    "Season_2010/Harbour_FC_11_2010.json": [
        player("h1", *ANN, "26", "€4.00m", "Team captain", foot="LEFT", signedFrom=":x"),
        player("h2", *BO, "35", "€2.00m", "Knee", nationality=[], signedFrom=None),
        *REJECTED,
    ],
    "Season_2010/FC_Quay_5_2010.json": [
        player("q1", *CY, "26", "€6.00m", nationality=["Z"]),
        player("q2", *TWIN, "19", "€2.00m", nationality=None),
    ],
    "Season_2010/North_Vale_7_2010.json": [player("z1", "Zed Nine", "Back", "31", "€6.00m")],
    "Season_2011/Harbour_FC_1_2011.json": [player("h1", *ANN, "27", "€5.00m")],
    "Season_2011/Harbour_FC_2_2011.json": [player("x9", *TWIN, "24", "€4.00m")],
    "Season_2011/FC_Quay_5_2011.json": [player("q2", *TWIN, "20", "€3.00m", "Ankle")],
    "Season_2011/North_Vale_7_2011.json": [],
    "Season_2012/North_Vale_7_2012.json": None,
    "Season_2012/AFC_Mill_3_2012.json": [player("m1", "Di Solo", "Keeper", "28", "€7.00m")],
    "Season_2013/Harbour_FC_11_2013.json": [
        player("h1", *ANN, "29", "€3.00m"),
        player("h3", "Ed New", "Back", "29", "€9.00m"),
    ],
    "Season_2014/Salt & Sand_9_2014.json": [
        player(f"s{i + 1:02d}", f"Sea {i + 1}", "Wing", age, value, (STATUS_2014 + [None] * 6)[i])
        for i, (age, value) in enumerate(zip(AGES_2014, VALUES_2014))
    ],
}
INDENTED = "Season_2010/Harbour_FC_11_2010.json"
MALFORMED = "Season_2013/AFC_Mill_3_2013.json"


def write_staging(root: Path) -> str:
    staging = root / "DATA_JSON"
    for number, (name, players) in enumerate(SQUADS.items()):
        document = {"id": str(number), "updatedAt": "2024-01-01T00:00:00Z"}
        if players is not None:
            document["players"] = players
        file = staging / name
        file.parent.mkdir(parents=True, exist_ok=True)
        text = json.dumps(document, ensure_ascii=False, indent=2 if name == INDENTED else None)
        file.write_text(text, encoding="utf-8")
    (staging / MALFORMED).write_text('{"id": "3", "players": [{"id": "m1", ', encoding="utf-8")
    return str(staging)
