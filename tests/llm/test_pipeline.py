"""The five stages over a small corpus with planted cases, against a plain Python run of them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from squadlake.llm import leaks
from squadlake.llm.tokens import tokenizer
from tests.llm.test_leaks_decontamination import plain_marks, plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_text_models import apart, plain_limits, plain_log_perplexity, plain_model

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, _hit int, spans string, gram int"
WORDS = {lang: [f"{stem}{end}" for stem in stems for end in ("", "en", "er", "ing")] for lang, stems in
         {"en": ["walk", "read", "light", "house", "water", "think"], "de": ["geh", "haus", "wasser", "denk", "lauf"]}.items()}
ITEMS = [(i, " ".join(f"question{i} word{j}" for j in range(10))) for i in range(4)] + [(9, None)]


def corpus():
    """(doc_id, text, lang) with poor texts, copies, near copies, benchmark passages, secrets, nulls and repeated rows."""
    pick = random.Random(21)

    def good(lang, n):
        return " ".join(pick.choice(WORDS[lang]) for _ in range(n)) + "."

    rows = []
    for i in range(150):
        lang = pick.choice(["en", "en", "de"])
        rows.append([i, good(lang, pick.randint(30, 80)), lang])
    for i in range(150, 170):  # poor
        rows.append([i, " ".join("".join(pick.choices("qxzjvw#@%&", k=7)) for _ in range(30)), "en"])
    for i in range(170, 180):  # exact copies, in capitals too
        rows.append([i, rows[i - 170][1] if i % 2 else rows[i - 170][1].upper().lower(), "en"])
    for i in range(180, 186):  # near copies: one word more at the end of a long text
        rows[i - 100][1] = good("en", 400)
        rows.append([i, rows[i - 100][1] + " lighter", "en"])
    for i in range(186, 194):  # benchmark passages, most of a document or a small part of a long one
        rows.append([i, f"{good('en', 20)} {ITEMS[i % 4][1]}" if i < 190 else f"{good('en', 900)} {ITEMS[i % 4][1]}", "en"])
    for i in range(194, 200):  # secrets
        rows.append([i, f"{good('en', 60)} token=reading{i}a walk {good('en', 5)}", "en"])
    rows += [[200, None, "en"], [201, "", "de"], [202, " \n", None], [None, good("en", 50), "en"], [3, rows[3][1], "en"]]
    return rows


def by_hand(rows, quality_of):
    trusted = [r for r in rows if r[0] in quality_of and quality_of[r[0]] and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    model = plain_model([r[1] or "" for r in trusted if not apart(r[0])])
    setting = [(r[2] or "", plain_log_perplexity(model, r[1])) for r in trusted if apart(r[0]) and r[1]]
    own = {lang: plain_limits([x for m, x in setting if m == lang]) for lang in {m for m, _ in setting}}
    everywhere = plain_limits([x for _, x in setting])
    stages = {}

    def passes(r):
        low, high = own.get(r[2] or "", everywhere)
        return bool(r[1]) and low <= plain_log_perplexity(model, r[1]) <= high

    rows = stages["quality"] = [r for r in rows if passes(r)]
    groups = defaultdict(list)
    roots = plain_components([r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows])
    for r, root in zip(rows, roots):
        groups[root if root is not None else (r[1],)].append(r)
    rows = stages["near_duplicates"] = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    rows = stages["decontamination"] = [r for r in rows if not plain_marks(r[1], ITEMS)[-1]]
    clean = []
    for doc_id, text, lang in rows:
        said, at = [], 0
        for start, _, end in plain_spans(text):
            if start >= at:
                said += [text[at:start], leaks.MARK]
            at = max(at, end)
        clean.append([doc_id, "".join(said) + text[at:], lang])
    stages["secrets"] = clean
    return stages


def shown(rows):
    return sorted((str(r[0]), r[1]) for r in rows)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus()
    whole = [(i, t, lang, "s", len(t or ""), "r", "k", 7, "[]", 1) for i, t, lang in rows]
    quality_of = {r[0]: int(r[0] < 150 or r[0] >= 170) for r in rows if r[0] is not None and r[0] < 200 and r[0] % 7}
    spark.createDataFrame(whole, COLUMNS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, passage string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in quality_of.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, by_hand(rows, quality_of)


def test_every_stage_is_that_of_plain_python(spark, sf_dir, tmp_path):
    folder, expected = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.dtypes == columns, name
        rows = docs.collect()
        assert shown((r.doc_id, r.text) for r in rows) == shown(expected[name]), name
        assert all(r.n_chars == len(r.text) for r in rows)
    left = {name: {str(r[0]) for r in expected[name]} for name in expected}
    assert not left["quality"] & {str(i) for i in range(150, 170)}
    assert not left["near_duplicates"] & {str(i) for i in (*range(170, 180), *range(180, 186))}
    assert not left["decontamination"] & {"186", "187", "188", "189"} and {"190", "191", "192", "193"} <= left["decontamination"]
    assert all("reading" not in t or "token=" not in t for _, t, _ in expected["secrets"])


def test_packed_pieces_hold_every_id_once(spark, sf_dir):
    folder, expected = sf_dir
    pieces = corpus_pipeline.run(spark, folder).collect()
    ids, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.input_ids) == p.length and p.ids_crc32 == zlib.crc32(np.array(p.input_ids, "<u4").tobytes())
        ids[p.doc_id].append((p.start, p.input_ids))
        sequences[p.sequence_id].append((p.offset, p.length))
    for doc_id, text, _ in expected["secrets"]:
        joined = [i for _, part in sorted(ids[doc_id]) for i in part]
        assert joined == [*tokenizer().encode(text, add_special_tokens=False).ids, 0]
    assert set(ids) == {r[0] for r in expected["secrets"]}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1_024


def test_stages_of_an_empty_table(spark, sf_dir, tmp_path):
    folder, _ = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name
