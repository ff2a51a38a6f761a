"""Shards against all partitions; search against all inner products."""

import random
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd

from squadlake.llm import search, sharding
from tests.compare import assert_same


def test_cuts_are_the_smallest_possible():
    pick = random.Random(5)
    for _ in range(80):
        sizes = [pick.randint(1, 30) for _ in range(pick.randint(1, 9))]
        parts = pick.randint(1, 4)
        ends = sharding.minimax_cuts(sizes, parts)
        assert len(ends) == parts and ends[-1] == len(sizes) and ends == sorted(ends)
        largest = max(sum(sizes[a:b]) for a, b in zip([0, *ends], ends))
        ways = combinations(sorted([*range(len(sizes) + 1)] * (parts - 1)), parts - 1)
        assert largest == min(max(sum(sizes[a:b]) for a, b in zip((0, *w), (*w, len(sizes)))) for w in ways)


def test_a_large_group_is_alone():
    alone, cuts = sharding.plan_shards([(7, 1000), *((i, 10) for i in range(8, 108))], 5)
    assert alone == {7: 4} and len(cuts) == 3


def check_shards(rows, texts, shards):
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in texts)
    group, slots = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    by_id = {str(i): t or "" for i, t in texts}
    for r in rows:
        text = by_id[str(r.doc_id)].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "bytes", None)
        assert group.setdefault(text, r.shard) == r.shard
    totals = [sum(r.size for r in rows if r.shard == s) for s in range(shards)]
    return totals


def test_shards_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    totals = check_shards(sharding.shard_digest(docs, 8).collect(), texts, 8)
    assert max(totals) < 1.1 * sum(totals) / 8 and min(totals) > 0.8 * sum(totals) / 8


def test_a_hot_group_stays_together_and_is_counted_in_cells(spark, documents):
    texts = ["same text"] * 300 + [f"text {i}" * 3 for i in range(300)]
    rows = sharding.shard_documents(documents(texts), 6, cell_rows=16).collect()
    assert len({r.shard for r in rows if r.text == "same text"}) == 1
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_odd_documents_in_shards(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    check_shards(sharding.shard_digest(odd).collect(), rows, 40)
    assert sharding.shard_digest(empty).count() == 0


def plain_search(rows, every, k):
    usable = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(usable):
        if q % every == 0:
            others = usable[:at] + usable[at + 1 :]
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in others if len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def got_search(spark, vectors, **how):
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in vectors], "vec_id long, embedding array<float>, score int, rank double")
    return sorted(tuple(r) for r in search.top_inner_products(frame, **how).select("query_id", "rank", "vec_id", "score").collect())


def test_search_is_brute_force_over_blocks_and_groups(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(pick.normal(0, 0.3, (300, 5))))]
    rows[7] = rows[11] = (7, rows[20][1])  # ties and a repeated row
    rows += [rows[30], rows[30], (40, rows[50][1]), (40, rows[60][1])]  # queries that repeat a row, or an id alone
    assert got_search(spark, rows, every=10, k=6, rows=64, queries=8) == plain_search(rows, 10, 6)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    duck = duckdb.connect()
    duck.execute("create table embeddings (vec_id bigint, embedding float[])")
    duck.executemany("insert into embeddings values (?, ?)", rows)
    assert_same(search.top_inner_products(frame), duck, search.SEARCH_SQL)


def test_search_leaves_out_what_cannot_be_compared(spark):
    rows = [(0, [1.0, -1.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, []), (6, [0.5, 0.5]), (20, [1.0, 2.0, 3.0]), (40, [-2.0, 3.5]), (40, [-2.0, 3.5]), (41, [0.0, 0.0])]
    assert got_search(spark, rows) == plain_search(rows, 20, 20)
    assert got_search(spark, []) == []


def test_slices_add_up_to_the_inner_product():
    pick = np.random.default_rng(9)
    values, query = pick.integers(-50, 50, (130, 7)), pick.integers(-40, 40, 7)
    index = search.BitSlices(values)
    slices, base = index.score(query)
    bits = np.stack([np.unpackbits(s.view(np.uint8), bitorder="little")[:130] for s in slices]).astype(np.int64)
    scores = (bits << np.arange(len(slices))[:, None]).sum(axis=0) + base
    assert (scores == values @ query).all()
    top = index.top(slices, 10)
    assert set(np.argsort(-scores, kind="stable")[:10]) <= set(top)
    assert isinstance(next(search.block_search(pd.DataFrame({"row": [0], "vec_id": [1], "v": [values[0]]}), pd.DataFrame({"row": [1], "vec_id": [2], "v": [query]}), 3)), pd.DataFrame)


def test_signed_digits_add_up_and_are_few():
    for number in range(-600, 601):
        digits = list(search._signed_digits(number))
        assert sum(sign << place for place, sign in digits) == number
        places = [place for place, _ in digits]
        assert all(b - a > 1 for a, b in zip(places, places[1:]))
