"""Fill-in-middle, token files and centroid clustering against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from squadlake.llm import centroids, fill_in_middle, token_files
from squadlake.llm.tokens import tokenizer

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

FIM_TEXTS = [
    None, "", " ", " \n\t", "a", " a", "a ", "one two  three\x0b\x0cfour", "one two  three\x0b\x0cfour",
    "Ünï  cödé x 漢 字 🙂 énd \x1c\x00 z", "has <S> inside it", "<P", "x < P> <M y <M > z", "w " * 40_000,
    "<P><S", "a <", "S> b <M", *[f"word{i} and some more, {i}\n text" for i in range(60)],
]


def fim_by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    drawn = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_units_are_those_of_the_pattern():
    texts = [t or "" for t in FIM_TEXTS]
    assert fill_in_middle.split_units(pa.array(texts, pa.large_string())).to_pylist() == [UNIT.findall(t) for t in texts]


@pytest.mark.parametrize("pass_bytes", [1, 1 << 24])
def test_fill_in_middle_by_hand(spark, documents, monkeypatch, pass_bytes):
    monkeypatch.setattr(fill_in_middle, "PASS_BYTES", pass_bytes)
    ids = [None, *range(1, len(FIM_TEXTS))]
    ids[8] = 7  # a repeated row
    docs = documents(FIM_TEXTS, ids)
    result = fill_in_middle.fill_in_middle(docs)
    rows = sorted(map(tuple, result.collect()), key=repr)
    assert rows == sorted((fim_by_hand(i, t) for i, t in zip(ids, FIM_TEXTS)), key=repr)
    assert {row[2] for row in rows} == {"plain", "spm", "psm"}
    digest = fill_in_middle.fill_in_middle_digest(docs).collect()
    assert sorted((r["restored_sha256"] for r in digest)) == sorted(
        hashlib.sha256((t or "").encode()).hexdigest() for t in FIM_TEXTS
    )


def test_fill_in_middle_takes_its_shares(spark):
    docs = spark.range(4_000).selectExpr("id as doc_id", "'a b c d e f' as text")
    forms = {r["form"]: r["count"] for r in fill_in_middle.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 2_000) < 150 and abs(forms["spm"] - 1_600) < 150 and abs(forms["psm"] - 400) < 100


def test_fill_in_middle_of_odd_and_empty(odd, empty):
    assert fill_in_middle.fill_in_middle_digest(odd).count() == odd.count()
    assert fill_in_middle.fill_in_middle_digest(empty).count() == 0


TOKEN_TEXTS = [
    None, "", " ", "a", "a <|endoftext|> b", "two  spaces\n\nand lines ", "Ünï 漢字 🙂   x", "same text", "same text",
    "other text of one id", "it's we'll 123 4567, (x)\t\ty", "z" * 20_000, *[f"Some words {i} and more." for i in range(300)],
]


def tokens_by_hand(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("width", [2, 4])
def test_token_files_by_hand(spark, documents, tmp_path, width):
    ids = [1_000 - 3 * i for i in range(len(TOKEN_TEXTS))]
    ids[5] = None
    docs = documents(TOKEN_TEXTS, ids).repartition(5)
    manifest = token_files.write_token_files(docs, str(tmp_path / "t"), width=width)
    rows = sorted(zip(ids, TOKEN_TEXTS), key=lambda r: (r[0] is not None, r[0]))
    expected = tokens_by_hand(rows)
    found = token_files.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected
    # The files are what the module says, one after another.
    parts = manifest.orderBy("part").collect()
    flat = np.concatenate([np.fromfile(tmp_path / "t" / f"{p['name']}.ids", f"<u{width}") for p in parts])
    assert flat.tolist() == [i for row in expected for i in row[4]]
    starts = [np.fromfile(tmp_path / "t" / f"{p['name']}.offsets", "<u8").tolist() for p in parts]
    assert [s for each in starts for s in each[:-1]] == [row[1] for row in expected]
    assert [each[-1] for each in starts] == [p["base"] + p["tokens"] for p in parts]


WORDS = ["a", " ", "  ", "\n", "\u00a0", "\u3000x", "\x1c", "it's", "1234", "Ünï", "漢字", "🙂", "\t", "...", "<|endoftext|>", "\x85", "Wort"]


def test_words_encoded_once_give_the_ids_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["", " ", *("".join(rng.choice(WORDS, rng.integers(1, 9))) for _ in range(3_000))]
    texts += [" ".join(rng.choice(WORDS, rng.integers(1, 9))) for _ in range(3_000)]
    expected = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_files, "KEPT_WORDS", 40)
    monkeypatch.setattr(token_files, "JOINED_WORDS", 7)
    words = token_files.LibraryWords()
    found = [x.tolist() for i in range(0, len(texts), 50) for x in words.encode(pa.array(texts[i : i + 50]))]
    assert found == expected


def test_repeated_ids_are_spread_and_gapless(spark, documents, tmp_path):
    texts = [f"text number {i % 7}" for i in range(400)]
    docs = documents(texts, [5] * 300 + list(range(100)))
    folder = str(tmp_path / "t")
    manifest = token_files.write_token_files(docs, folder)
    found = token_files.read_token_files(spark, folder, with_ids=False).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted([5] * 300 + list(range(100)))
    assert [r["start"] for r in found] == np.append(0, np.cumsum([r["n_tokens"] for r in found]))[:-1].tolist()
    assert sorted(r["ids_crc32"] for r in found) == sorted(r[3] for r in tokens_by_hand([(0, t) for t in texts]))
    assert manifest.agg({"documents": "sum"}).first()[0] == 400


def test_a_lost_attempt_leaves_the_files_right(spark, documents, tmp_path):
    docs, folder = documents(TOKEN_TEXTS), tmp_path / "t"
    token_files.write_token_files(docs, str(folder))
    (folder / "0123456789abcdef.ids").write_bytes(b"\x01\x02\x03")
    found = token_files.read_token_files(spark, str(folder), with_ids=False)
    assert found.count() == len(TOKEN_TEXTS)


def test_token_files_of_odd_and_empty(spark, odd, empty):
    assert token_files.token_files_digest(odd).count() == odd.count()
    result = token_files.token_files_digest(empty)
    assert result.count() == 0 and result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def quantise(vector):
    return [int(np.floor(64 * float(np.float32(x)))) for x in vector]


def clusters_by_hand(rows, number=16, rounds=3):
    kept = [(i, quantise(v)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    middle = [v for _, v in first[:number]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in kept]
        moved = []
        for n, c in enumerate(middle):
            own = [v for (_, v), f in zip(kept, found) if f == n]
            moved.append([sum(x) // len(own) for x in zip(*own)] if own else c)
        middle = moved
    found = [near(v) for _, v in kept]
    per = {n: sum(d for d, m in found if m == n) for n in range(len(middle))}
    total = sum(d for d, _ in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, n, d, per[n], total, sha[n]) for (i, _), (d, n) in zip(kept, found)]


def vector_table(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 7, 3.5) for i, v in rows], "vec_id long, embedding array<float>, label int, cluster int, distance double"
    )


def random_rows(seed, count, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, scale, 64).astype(np.float32)]) for i in range(count)]


def test_centroid_clusters_by_hand(spark):
    rows = random_rows(3, 150)
    rows += rows[:20]  # repeated rows
    rows += [(i, [float(j % 3) for j in range(64)]) for i in range(500, 520)]  # ties
    rows += [(None, rows[0][1]), (7, rows[1][1]), (900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65)]
    rows += [(904, [None] + [1.0] * 63), (905, [float("nan")] * 64), (906, [float("inf")] + [0.0] * 63)]
    found = centroids.centroid_clusters(vector_table(spark, rows))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(clusters_by_hand(rows), key=repr)


def test_few_equal_and_no_vectors(spark):
    for rows in (random_rows(4, 5), [(1, [0.25] * 64)] * 40, [(1, [0.25] * 63), (2, None)], []):
        found = centroids.centroid_clusters(vector_table(spark, rows)).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(clusters_by_hand(rows), key=repr)


def test_large_components_are_exact(spark):
    rows = random_rows(5, 30) + [(i + 100, v) for i, v in random_rows(6, 30, 1e6)]
    found = centroids.centroid_clusters(vector_table(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(clusters_by_hand(rows), key=repr)
    beyond = vector_table(spark, [(1, [1e30] * 64), (2, [-1e30] * 64), (3, [0.0] * 64)])
    assert centroids.centroid_clusters(beyond).count() == 3


@pytest.mark.parametrize("seed", range(6))
def test_nearest_is_exact_with_ties(seed):
    rng = np.random.default_rng(seed)
    values, middle = rng.integers(-3, 4, (300, 5)), rng.integers(-3, 4, (1 + seed * 3, 5))
    cluster, distance = centroids.nearest(values, middle)
    squares = ((values[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (cluster == squares.argmin(axis=1)).all() and (distance == squares.min(axis=1)).all()


def test_the_walk_stops_before_all_centroids_are_met():
    """With one far cluster of centroids a vector near another is done without their distances."""
    middle = np.array([[0, 0], [1, 1], *[[1_000 + i, 1_000 + i] for i in range(50)]])
    met = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                met.extend(key.tolist())
            return np.asarray(super().__getitem__(key))

    cluster, _ = centroids.nearest(np.array([[0, 1]]), middle.view(Watched))
    assert cluster.tolist() == [0] and len(set(met)) < 5
