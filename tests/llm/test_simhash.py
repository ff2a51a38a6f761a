"""Fingerprints and components, against brute force."""

import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from squadlake.llm import simhash
from squadlake.llm.components import components


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\v", " ").replace("\f", " ")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(i)
    least = {r: min((ids[i] for i in g if ids[i] is not None), default=None) for r, g in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


def near_copies(seed=3, n=60):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        base = [pick.choice(words) for _ in range(pick.randint(1, 120))]
        for _ in range(pick.randint(1, 4)):
            copy = base[:]
            if pick.random() < 0.7:
                copy[pick.randrange(len(copy))] = pick.choice(words)
            texts.append(pick.choice([" ", "\n", "  "]).join(copy))
    return texts


def test_digest_is_brute_force(documents, odd):
    texts = near_copies()
    for docs in (documents(texts), odd):
        rows = docs.select("doc_id", "text").collect()
        ids, prints = [r.doc_id for r in rows], [plain_fingerprint(r.text) for r in rows]
        expected = sorted(zip(map(str, ids), (f"{p:016x}" for p in prints), map(str, plain_components(ids, prints))))
        got = simhash.simhash_digest(docs).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected


def close_prints(n, seed=1):
    """Around a few centres, so that shards overflow and are split."""
    pick = random.Random(seed)
    out = set()
    for centre in (0, pick.getrandbits(64), (1 << 64) - 1):
        while len(out) < n * (1 + (centre > 0)):
            x = centre
            for _ in range(pick.randint(0, 5)):
                x ^= 1 << pick.randrange(64)
            out.add(x)
            centre = centre if pick.random() < 0.9 else pick.getrandbits(64)
    return sorted(out)


def test_split_shards_lose_no_link(spark):
    prints = close_prints(150)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint long")
    roots = {r.node & (2**64 - 1): r.root for r in components(simhash.link_fingerprints(frame, tree=8)).collect()}
    expected = plain_components(prints, prints)
    groups = defaultdict(set)
    for p, root in zip(prints, expected):
        groups[root].add(p)
    for root, members in groups.items():
        assert len({roots.get(p, simhash._signed(p)) for p in members}) == 1
    assert len({roots.get(p, simhash._signed(p)) for p in prints}) == len(groups)


def test_thirds_end_within_a_tree():
    masks = [0]
    for _ in range(5):
        masks = sorted({m for mask in masks for m in simhash.thirds(mask)})
    assert all(64 - bin(m).count("1") <= 10 for m in masks)


def test_trees_follow_only_edges_in_reach():
    prints = np.array(close_prints(60, 5), np.uint64)
    forest = simhash.Forest(prints, np.zeros(len(prints), int))
    found = {(int(a), int(b)) for x, y in forest.within(2) for a, b in zip(x, y)}
    n = len(prints)
    assert found == {(i, j) for i in range(n) for j in range(n) if i != j and int(prints[i] ^ prints[j]).bit_count() <= 2}


def test_one_of_each_keeps_the_smallest_id_and_all_columns(documents, odd, empty):
    text = " ".join(f"word{i}" for i in range(50))
    docs = documents([text, "other thing entirely here", text, text, text], [5, 9, 3, 3, None])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 9]
    # The three without words are alike, and so are repeated rows.
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(odd).collect()) == ["0", "3", "4", "7", "None"]
    assert simhash.one_of_each(empty).count() == 0 and simhash.simhash_digest(empty).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(301)}
