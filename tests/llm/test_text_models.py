"""Held-out accuracy of the trained models, repeated passages against brute force, and odd tables."""

import itertools
import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from squadlake.llm import quality, suffixes, toxicity
from squadlake.llm.common import is_held_out, table
from squadlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_labels(spark):
    large = "/root/testdata/sf0.1"
    labels = table(spark, large, "labels")
    scored = QUERIES["op4_toxicity"](spark, large).join(labels, "doc_id").where("held_out").collect()
    clean = [r.predicted for r in scored if r.toxic == 0]
    toxic = [r.predicted for r in scored if r.toxic == 1 and r.quality == 1]
    assert np.mean(clean) < 0.02 and np.mean(toxic) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)


def plain_sentences(text):
    text = unicodedata.normalize("NFC", text.lower())
    stops = "\n\r\v\f\x85\u2028\u2029。！？"
    text = "".join("\n" if c in stops or i and c.isspace() and text[i - 1] in ".!?…" else c for i, c in enumerate(text))
    out = []
    for line in text.split("\n"):
        words = "".join(c for c in line if c.isalpha() or c.isspace()).split()
        joined = [w if i == 0 or len(w) > 1 or len(words[i - 1]) > 1 else "\0" + w for i, w in enumerate(words)]
        if words:
            out.append(" ".join(joined).replace(" \0", ""))
    return out


def test_sentences_are_plain_python(documents):
    pick = random.Random(3)
    pieces = ["a", "B", "word", "İd", "e\u0301t", "x-y", "...", ".", "! ", "?", " ", "  ", "\t", "\n", "\u2028", "。", "漢字", "4", "\ud800", ""]
    texts = ["", " ", ".", "\n\n", "i d i o t"] + ["".join(pick.choice(pieces) for _ in range(pick.randrange(40))) for _ in range(400)]
    symbols, begins, owner = toxicity.coded(texts)
    ends = [*begins[1:], len(symbols)]
    got = [(int(n), "".join(chr(c) if c else " " for c in symbols[a:b]).rstrip(" ")) for n, a, b in zip(owner, begins, ends)]
    assert got == [(n, sentence) for n, text in enumerate(texts) for sentence in plain_sentences(text)]
    edge = toxicity.WINDOW - 1
    assert all(not symbols[a - edge : a].any() for a in begins) and not symbols[-edge:].any() and begins[0] == edge


def plain_kernel(one, two):
    """Sum over shared subsequences of four symbols, with gaps, of both weights."""

    def weights(window):
        out = Counter()
        for first in range(toxicity.ANCHORS):
            for rest in itertools.combinations(range(first + 1, first + toxicity.SPAN), 3):
                found = tuple(window[i] for i in (first, *rest))
                if any(found):
                    out[found] += toxicity.DECAY ** (rest[-1] - first + 1) / toxicity.NORM
        return out

    mine, others = weights(one), weights(two)
    return sum(w * others[s] for s, w in mine.items())


def windows_of(*texts):
    rows = [[ord(c) if c != " " else 0 for c in t.ljust(toxicity.WINDOW)[: toxicity.WINDOW]] for t in texts]
    return np.array(rows, np.uint32)


def test_kernel_is_brute_force_and_forgives_inserted_characters():
    windows = windows_of("n worthless dop", "e worxthless ka", "s wor thless im", "n waterfalls so", "a" * 20, "", "été à la mer")
    kernel = toxicity.Landmarks.of(windows).kernel(windows)
    assert kernel == pytest.approx(np.array([[plain_kernel(a, b) for b in windows] for a in windows]), rel=1e-4, abs=1e-5)
    same, near, split, far = kernel[:4, 0]
    assert min(near, split) > 0.3 * same and min(near, split) > 4 * far


def test_margins_are_those_of_the_worst_window(monkeypatch):
    pick = np.random.default_rng(1)
    model = toxicity.Model(pick.normal(size=1 << toxicity.BITS).astype(np.float32), -0.5, np.array([0.0, 1.0]))
    texts = ["idiot", "x" * 100 + " an idiot. Not so! " + "y" * 100, "", "zzz", "ab cd " * 3_000 + "moron" + " ef gh" * 3_000]
    margins = model.margins(texts)
    for text, margin in zip(texts, margins):
        of = []
        for sentence in plain_sentences(text):
            padded = " " * (toxicity.WINDOW - 1) + sentence + " " * toxicity.WINDOW
            of.append(model.of_windows(windows_of(*{padded[i : i + toxicity.WINDOW] for i in range(len(padded) - toxicity.WINDOW)})).max())
        assert margin == pytest.approx(max(of, default=toxicity.NOTHING), abs=1e-3)
    monkeypatch.setattr(toxicity, "PART", 2_000)
    assert all(model.margins(texts) > margins - 1e-3)  # no window is missed; a part's end is read as a sentence's


def test_one_insult_is_enough(spark, documents):
    """Of each toxic document one sentence holds one insult; nobody says which."""
    pick = random.Random(8)
    syllables = ["an", "er", "tho", "li", "on", "re", "st", "ka", "mi", "do", "pe", "lu"]
    word = lambda: "".join(pick.choice(syllables) for _ in range(pick.randint(1, 4)))
    insults = ["blockhead", "nitwit", "buffoon"]
    texts, toxic = [], []
    for n in range(900):
        words = [word() + pick.choice(["", "", "", ".", ","]) for _ in range(pick.randint(5, 120))]
        toxic.append(int(n % 4 == 0))
        if toxic[-1]:
            words.insert(pick.randrange(len(words)), pick.choice(insults))
        texts.append(" ".join(words))
    labels = spark.createDataFrame([(n, 1, t) for n, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    docs = documents(texts)
    rows = toxicity.toxicity_digest(docs, labels).where("held_out").collect()
    assert np.mean([r.predicted for r in rows if toxic[r.doc_id]]) > 0.9
    assert np.mean([r.predicted for r in rows if not toxic[r.doc_id]]) < 0.04
    model = toxicity.train(docs, labels)
    forms = ["{0}", "{0}!!", "{1}-{2}", "{1}*{2}", "{1}{2}S", "{1} {2}", "{1}x{2}"]
    sentences = [f.format(w, w[:3], w[3:]) for f in forms for w in insults] + [" ".join(w) for w in insults]
    scores = model.score(model.margins([f"tholi anre {s} dope lu kami" for s in sentences]))
    assert np.mean(scores >= 0.7) > 0.85 and model.score(model.margins(["tholi anre dope lu kami", ""])).max() < 0.7


def test_toxicity_of_odd_documents(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1, 1), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_digest(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity_digest(empty, labels.limit(0)).count() == 0


def test_quality_on_held_out_labels(spark):
    labels = table(spark, SF_DIR, "labels").where(is_held_out())
    judged = QUERIES["op5_quality_classifier"](spark, SF_DIR).join(labels, "doc_id").collect()
    assert np.mean([r.kept for r in judged if r.quality == 1]) > 0.95
    assert np.mean([r.kept for r in judged if r.quality == 0]) < 0.4


def plain_grams(text):
    raw = text.encode("utf-16-le")
    units = [0] * (quality.ORDER - 1) + [int.from_bytes(raw[i : i + 2], "little") for i in range(0, len(raw), 2)]
    return [tuple(units[i : i + quality.ORDER]) for i in range(len(units) - quality.ORDER + 1)]


def plain_model(texts):
    """Interpolated modified Kneser-Ney by the book: the probability of a gram's last symbol."""
    counts = {quality.ORDER: Counter(g for t in texts for g in plain_grams(t))}
    for n in range(quality.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    totals, left = {}, {}
    for n, of_order in counts.items():
        have = Counter(of_order.values())
        a, b, d, e = (max(1, have[i]) for i in (1, 2, 3, 4))
        y = a / (a + 2 * b)
        found = (1 - 2 * y * b / a, 2 - 3 * y * d / b, 3 - 4 * y * e / d)
        off = [min(max(x, 0.1), most) for x, most in zip(found, (1.0, 2.0, 3.0))]
        for g, c in of_order.items():
            totals[g[:-1]] = totals.get(g[:-1], 0) + c
            left[g[:-1]] = left.get(g[:-1], 0) + off[min(c, 3) - 1]
        counts[n] = {g: max(c - off[min(c, 3) - 1], 0) for g, c in of_order.items()}

    def p(g):
        if not g:
            return 1 / 65_536
        context = g[:-1]
        if context not in totals:
            return p(g[1:])
        return (counts[len(g)].get(g, 0) + left[context] * p(g[1:])) / totals[context]

    return p


def plain_log_perplexity(p, text):
    grams = plain_grams(text)
    return -sum(math.log(p(g)) for g in grams) / len(grams)


def plain_limits(logs):
    """(low, high) from log-perplexities, by the counts in steps that the operator reads them from."""
    steps, margin = sorted(math.floor(x / quality.STEP) for x in logs), quality.UNSURE / math.sqrt(len(logs))
    upto = {s: sum(t <= s for t in steps) for s in steps}
    low = min(s for s in steps if upto[s] > quality.LOWEST * len(steps))
    high = min(s for s in steps if upto[s] >= quality.PASSING * len(steps))
    return low * quality.STEP - margin, (high + 1) * quality.STEP + margin


def test_model_is_kneser_ney(spark, documents, monkeypatch):
    monkeypatch.setattr(quality, "TOGETHER", 50)
    texts = ["the cat sat. The dog,", "a cat 12 and a dog", "zebra crossing!", "the the the", "Ünï 漢字 🙂 \uffff 🙃", "", None] * 2
    texts += [f"word {i} of many" for i in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        model = quality.train(documents(texts))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(model.seen[-1].shards) > 2
    plain = plain_model([t or "" for t in texts])
    for text in ("the dot. Quiz 3 cats", "漢 🙂🙃 zzz \uffff", "many words of the " * 9):
        for key, gram in zip(model.log_p(quality.n_grams(quality.units_of(text))), plain_grams(text)):
            assert key == pytest.approx(math.log(plain(gram)), abs=1e-9)
    for context in ("the", " a ", "漢字 ", "qqq"):
        units = quality.units_of(context)[-3:]
        keys = (units[0] << 32 | units[1] << 16 | units[2]) << 16 | np.arange(65_536)
        assert np.exp(model.log_p(keys)).sum() == pytest.approx(1, abs=1e-9)


def test_long_texts_are_scored_in_pieces(documents, monkeypatch):
    texts = ["abcdefgh " * 300, "x", "", None, "one two three"]
    model = quality.train(documents(texts))
    whole = [r.p for r in quality.with_perplexity(documents(texts), model, "p").collect()]
    monkeypatch.setattr(quality, "TOGETHER", 7)
    assert [r.p for r in quality.with_perplexity(documents(texts), model, "p").collect()] == pytest.approx(whole, nan_ok=True)
    assert whole[2] is whole[3] is None


def apart(doc_id):
    """Whether a trusted document sets limits: xxHash64 of the id's eight bytes, seed 42, as a signed long."""
    return xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little"), 42) % quality.SET_APART == 0


def test_limits_and_flags_are_those_of_plain_python(spark, documents):
    pick = random.Random(8)
    words = {"en": ["the", "cat", "sat", "on", "mat", "dog"], "de": ["der", "Hund", "und", "die", "Katze"], "xx": ["ky", "zo"]}
    texts, langs = [], []
    for i in range(260):
        lang = pick.choice(["en"] * 5 + ["de"] * 3 + ["xx", None])
        said = [pick.choice(words[lang or "en"]) for _ in range(pick.randint(3, 25))]
        if i % 9 == 0:
            said = ["".join(pick.choices("qxzjwv#@", k=6)) for _ in said]
        elif i % 13 == 0:
            said = [said[0]] * 60
        texts.append(" ".join(said) + ".")
        langs.append(lang)
    quality_of = {i: int(i % 9 != 0 and i % 13 != 0 and langs[i] != "xx") for i in range(260) if i % 5}
    labels = spark.createDataFrame([(i, q, 0) for i, q in quality_of.items()], "doc_id long, quality int, toxic int")
    trusted = [i for i, q in quality_of.items() if q and zlib.crc32(str(i).encode()) % 3 != 1]
    model = plain_model([texts[i] for i in trusted if not apart(i)])
    logs = [plain_log_perplexity(model, t) for t in texts]
    setting = [i for i in trusted if apart(i)]
    own = {lang: plain_limits([logs[i] for i in setting if (langs[i] or "") == lang]) for lang in {langs[i] or "" for i in setting}}
    everywhere = plain_limits([logs[i] for i in setting])
    expected = []
    for i, log in enumerate(logs):
        low, high = own.get(langs[i] or "", everywhere)
        expected.append(low <= log <= high)
    rows = sorted(quality.quality_digest(documents(texts, langs=langs), labels).collect())
    assert [r.perplexity for r in rows] == pytest.approx([math.exp(x) for x in logs])
    assert [r.kept for r in rows] == expected and 0 < sum(expected) < 260


def test_quality_of_odd_documents(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_digest(odd, labels).collect()
    assert len(rows) == odd.count() and not any(r.kept for r in rows if r.perplexity is None)
    assert quality.trusted_quality(odd, labels).columns == odd.columns
    assert quality.quality_digest(empty, labels.limit(0)).count() == 0
    assert all(r.kept for r in quality.quality_digest(odd, labels.limit(0)).collect() if r.perplexity)


def plain_passages(rows):
    words = [(i, (t or "").split()) for i, t in rows]
    seen = Counter(tuple(w[s : s + 50]) for _, w in words for s in range(len(w) - 49))
    out = []
    for i, w in words:
        covered = [False] * (len(w) + 1)
        for s in range(len(w) - 49):
            if seen[tuple(w[s : s + 50])] > 1:
                covered[s : s + 50] = [True] * 50
        starts = [k for k in range(len(w)) if covered[k] and (k == 0 or not covered[k - 1])]
        out += [(str(i), a, next(k for k in range(a, len(w) + 1) if not covered[k])) for a in starts]
    return sorted(out)


def test_passages_are_brute_force(spark, documents, odd, empty):
    pick = random.Random(11)
    new = lambda n: [f"v{pick.randrange(10**6)}" for _ in range(n)]
    shared = [new(n) for n in (50, 51, 60, 140, 49)]
    texts = [" ".join(new(pick.randint(0, 90)) + pick.choice(shared) + new(pick.randint(0, 90))) for _ in range(40)]
    texts += [" ".join(new(20) + shared[3][a : a + 70] + new(20)) for a in (0, 10, 35, 70)] + [texts[0], " ".join(new(400))]
    for docs in (documents(texts), odd):
        got = sorted((str(r.doc_id), r.begin, r.end) for r in suffixes.repeated_passages(docs).collect())
        assert got == plain_passages([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert suffixes.repeated_passages(empty).count() == 0


def test_passages_of_templates_are_brute_force(spark, documents):
    """Heads and tails vary about one core: most of the pages with one head aren't neighbours in suffix order."""
    pick = random.Random(5)
    new = lambda n: [f"v{pick.randrange(10**6)}" for _ in range(n)]
    texts = []
    for size in (40, 60, 60, 60):
        heads, core = [new(15) for _ in range(10)], new(size)
        texts += [" ".join([*pick.choice(heads), *core, *new(30)]) for _ in range(60)]
    docs = documents(texts)
    got = sorted((str(r.doc_id), r.begin, r.end) for r in suffixes.repeated_passages(docs).collect())
    assert got == plain_passages(enumerate(texts))


def test_a_suffix_is_not_its_own_neighbour(spark):
    """A task with one suffix gives it under both its edges."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, 1, words, "", 0), (1, 1, words, "", 1), (1, 2, words + " x", "", 2), (2, 3, words, "", 5)]
    edges = spark.createDataFrame(rows, "gram long, around long, suffix string, before string, edge int")
    found = suffixes._over_borders(edges).collect()
    assert sorted((r.around, r.matched_right) for r in found) == [(1, 60), (2, 60)]
    assert suffixes._over_borders(edges.where("edge < 2")).count() == 0


def test_pipeline_keeps_columns_and_obeys_each_stage(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns and set(after) <= before and len(after) == len(set(after)), name
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id").distinct().count()
    assert packed == docs.count()
