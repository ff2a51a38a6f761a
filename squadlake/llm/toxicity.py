"""Toxicity: a gap-weighted subsequence kernel over sentences, Nyström landmarks, a support vector machine.

A sentence is its letters in order, with one boundary for each run of white space; whatever else stands between
letters, and boundaries between single letters, don't count. The kernel compares windows of its symbols by the
subsequences of four they share, with gaps, within SPAN, so that an insult split in two, spelt out or with
characters put in still has most of them. A sentence's margin is the highest of its windows', a
document's that of its worst sentence.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import findable, is_held_out, kept, whole

#: Labelled documents the classifier is fitted on, the first by a hash of their id.
TRAIN_DOCUMENTS = 12_000
#: Subsequences are four symbols within SPAN; each symbol spanned multiplies their weight by DECAY.
SPAN, DECAY = 6, 0.6
#: Subsequences of one window begin at so many neighbouring symbols; a window reaches over WINDOW symbols.
ANCHORS = 10
WINDOW = ANCHORS + SPAN - 1
#: Subsequences are told apart by so many bits of a hash.
BITS = 20
#: Rounds that choose the toxic sentences of toxic documents anew; in the first FREE ones each has one at least.
ROUNDS, FREE = 5, 2
#: Sentences a clean and a toxic document shows in each round.
SHOWN = (4, 6)
LANDMARKS = 512
#: Shrinkage of the machine, for each unit of weight.
RIDGE = 1e-4
#: Windows the fit computes with at once.
BLOCK = 2048
#: Characters a task holds in its arrays at once; longer texts are read in parts, each from OVERLAP before, and a
#: part's ends are read as those of sentences.
PART, OVERLAP = 1 << 20, 1_000
THRESHOLD = 0.7
#: The share of clean training documents that score below THRESHOLD, and how scores grow with the margin.
CLEAN_SHARE, SLOPE = 0.99, 4.0

GAPS = [(0, a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]
#: An odd multiplier for each place of a subsequence; four boundaries have the hash 0.
FACTORS = tuple(map(np.uint32, (2654435761, 2246822519, 3266489917, 668265263)))
#: What a window's sum is divided by: the norm of the weights of its subsequences.
NORM = float(np.sqrt(ANCHORS * sum(DECAY ** (2 * (gaps[-1] + 1)) for gaps in GAPS)))
#: Margin of a text without letters.
NOTHING = -3.0

BOUNDARY, STOP, DROPPED, END = 0, 0xFFFFFFFE, 0xFFFFFFFF, 0x110000


@cache
def _symbols() -> np.ndarray:
    """What each code point stands for: a letter (itself), a boundary, a stop, or nothing; END is a stop."""
    out = np.full(END + 1, DROPPED, np.uint32)
    for point in range(0x20000):
        c = chr(point)
        if c in "\n\r\v\f\x85  。！？":
            out[point] = STOP
        elif c.isspace():
            out[point] = BOUNDARY
        elif c.isalpha():
            out[point] = point
    out[0x20000:0xE0000] = np.arange(0x20000, 0xE0000)
    out[END] = STOP
    return out


def _composed(text: str) -> str:
    return unicodedata.normalize("NFC", text.lower())


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all sentences, where each begins, the number of its text).

    WINDOW - 1 boundaries stand before, between and behind sentences, so that no window holds letters of two, or of none. A sentence ends
    with a line, with one of ``。！？``, or with one of ``.!?…`` before white space.
    """
    tail = END.to_bytes(4, "little")
    points = np.frombuffer(b"".join(_composed(t).encode("utf-32-le", "surrogatepass") + tail for t in texts), np.uint32)
    symbols = _symbols()[points]
    text = np.cumsum(points == END, dtype=np.int32)
    marks = np.flatnonzero(np.isin(points[:-1], [ord(c) for c in ".!?…"]) & (symbols[1:] == BOUNDARY))
    symbols[marks + 1] = STOP
    left = symbols != DROPPED
    symbols, text = symbols[left], text[left]
    stop = symbols == STOP
    gap = stop | (symbols == BOUNDARY)
    before, after = np.append(True, gap[:-1]), np.append(gap[1:], True)
    # of each run of gaps the first stays, unless the texts begin with it, as a stop if one is in the run
    begins, ends = np.flatnonzero(gap & ~before), np.flatnonzero(gap & ~np.append(gap[1:], False))
    seen = np.cumsum(stop)
    if len(ends) > len(begins):
        ends = ends[1:]
    stop = np.zeros(len(symbols), bool)
    stop[begins] = seen[ends] > np.where(begins > 0, seen[begins - 1], 0)
    alone = ~gap & before & after
    symbols = np.where(gap, np.uint32(0), symbols)
    left = ~gap
    left[begins] = True
    symbols, text, stop, gap, alone = symbols[left], text[left], stop[left], gap[left], alone[left]
    spelt = gap & ~stop
    spelt[1:] &= alone[:-1]
    spelt[:-1] &= alone[1:]
    symbols, text, stop = symbols[~spelt], text[~spelt], stop[~spelt]
    if not len(symbols):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, stop[:-1]))
    size = np.where(stop, WINDOW - 1, 1)
    place = WINDOW - 1 + np.cumsum(size) - size
    return np.append(np.zeros(WINDOW - 1, np.uint32), np.repeat(symbols, size)), place[first], text[first].astype(np.int64)


def _keys(symbols: np.ndarray, gaps: tuple[int, ...], length: int) -> np.ndarray:
    """Hashes of the subsequences with these gaps that begin at the first ``length`` symbols (the last axis)."""
    total = symbols[..., :length] * FACTORS[0]
    for by, factor in zip(gaps[1:], FACTORS[1:]):
        total += symbols[..., by : by + length] * factor
    return total >> np.uint32(32 - BITS)


class Model(NamedTuple):
    """A machine over landmarks, written out in the kernel's features, and the scale of its scores."""

    weights: np.ndarray
    bias: float
    scale: np.ndarray

    def windows(self, symbols: np.ndarray) -> np.ndarray:
        """Signed distance of the window from each symbol on."""
        n = len(symbols) - SPAN + 1
        total = np.zeros(n, np.float32)
        for gaps in GAPS:
            total += np.take(self.weights, _keys(symbols, gaps, n)) * np.float32(DECAY ** (gaps[-1] + 1))
        upto = np.append(0, np.cumsum(total, dtype=np.float64))
        return (upto[ANCHORS:] - upto[:-ANCHORS]) / NORM + self.bias

    def of_windows(self, windows: np.ndarray) -> np.ndarray:
        """Signed distance of single windows."""
        keys, weights = subsequences(windows)
        return np.take(self.weights, keys) @ weights + self.bias

    def margins(self, texts: list[str]) -> np.ndarray:
        """The highest margin of each text; NOTHING if it has no letter."""
        out = np.full(len(texts), NOTHING)
        for numbers, part in _parts(texts):
            symbols, begins, owner = coded(part)
            if len(begins):
                of_sentence = np.maximum.reduceat(self.windows(symbols), begins - WINDOW + 1)
                np.maximum.at(out, np.array(numbers)[owner], of_sentence)
        return out

    def score(self, margins: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + self.scale[1] * margins, -40, 40)))


def _parts(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, or parts of long ones, with their numbers, about PART characters at a time."""
    numbers, held, size = [], [], 0
    for n, text in enumerate(texts):
        for at in range(0, max(len(text), 1), PART):
            piece = text[max(0, at - OVERLAP) : at + PART]
            if held and size + len(piece) > PART:
                yield numbers, held
                numbers, held, size = [], [], 0
            numbers.append(n)
            held.append(piece)
            size += len(piece)
    if held:
        yield numbers, held


def subsequences(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of each window's subsequences, their weights); four boundaries, of hash 0, count as none."""
    keys = np.hstack([_keys(windows, gaps, ANCHORS) for gaps in GAPS])
    return keys, np.repeat([DECAY ** (gaps[-1] + 1) for gaps in GAPS], ANCHORS).astype(np.float32) / np.float32(NORM)


class Landmarks(NamedTuple):
    """The features of some windows: hashes they have, and a row of weights for each, with one of zeros behind."""

    keys: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, windows: np.ndarray) -> Landmarks:
        keys, weights = subsequences(windows)
        known = np.unique(keys[keys > 0])
        rows = np.zeros((len(known) + 1, len(windows)), np.float32)
        column = np.broadcast_to(np.arange(len(windows))[:, None], keys.shape)
        at = np.where(keys > 0, np.searchsorted(known, keys), len(known))
        np.add.at(rows, (at, column), np.broadcast_to(weights, keys.shape))
        rows[-1] = 0
        return cls(known, rows)

    def kernel(self, windows: np.ndarray) -> np.ndarray:
        """The kernel between windows and landmarks."""
        out = np.zeros((len(windows), self.rows.shape[1]), np.float32)
        if not len(self.keys):
            return out
        keys, weights = subsequences(windows)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        at = np.where(self.keys[at] == keys, at, len(self.keys))
        for j, weight in enumerate(weights):
            out += self.rows[at[:, j]] * weight
        return out


def fit_machine(windows: np.ndarray, label: np.ndarray, weight: np.ndarray, landmarks: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights over the kernel's features, and bias.

    The kernel between windows and landmarks, times the inverse root of that among landmarks, gives each
    window as many numbers as there are landmarks; the machine (squared hinge, by Newton's method) is linear
    in these and so in the kernel's features.
    """
    marks = Landmarks.of(landmarks)
    values, vectors = np.linalg.eigh(marks.kernel(landmarks).astype(np.float64))
    good = values > max(1e-4 * values.max(), 1e-9)
    root = vectors[:, good] / np.sqrt(values[good])
    root = root.astype(np.float32)
    x = np.ones((len(windows), root.shape[1] + 1), np.float32)
    blocks = [slice(i, i + BLOCK) for i in range(0, len(windows), BLOCK)]
    for block in blocks:
        x[block, :-1] = marks.kernel(windows[block]) @ root
    y, w = np.where(label, 1.0, -1.0), np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * RIDGE * weight.sum()
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        squares, sums = ridge.copy(), np.zeros(len(w))
        for block in blocks:
            inside = y[block] * (x[block] @ w) < 1
            active, c = x[block][inside], weight[block][inside].astype(np.float32)
            squares += active.T @ (active * c[:, None])
            sums += active.T @ (c * y[block][inside])
        step = np.linalg.solve(squares, sums)
        if np.allclose(step, w, atol=1e-6):
            break
        w = step
    table = np.zeros(1 << BITS, np.float32)
    table[marks.keys] = marks.rows[:-1] @ (root @ w[:-1])
    return table, float(w[-1])


def scale_of(clean: np.ndarray) -> np.ndarray:
    """The scale by which CLEAN_SHARE of clean documents, by their margins, score below THRESHOLD."""
    limit = np.quantile(clean, CLEAN_SHARE) if len(clean) else 0.0
    return np.array([np.log(THRESHOLD / (1 - THRESHOLD)) - SLOPE * limit, SLOPE])


def training_documents(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> DataFrame:
    """``text, toxic`` of at most ``most`` labelled documents that aren't held out, equal texts once."""
    chosen = (
        labels.where(~is_held_out() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = findable(docs).select("doc_id", whole(F.col("text")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _first_weights(trained: DataFrame) -> np.ndarray:
    """How much more often, as a logarithm, each four neighbours stand in toxic documents than in others."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                have = [np.zeros(0, np.uint32)]
                for _, part in _parts([text]):
                    symbols = coded(part)[0]
                    have.append(np.unique(_keys(symbols, GAPS[0], max(len(symbols) - SPAN, 0))))
                found[int(toxic), np.unique(np.concatenate(have))] += 1
        keys = np.flatnonzero(found.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(found[0][keys]), pa.array(found[1][keys])], ["key", "clean", "toxic"])

    counts = trained.mapInArrow(count, "key long, clean long, toxic long").groupBy("key").agg(F.sum("clean"), F.sum("toxic"))
    rows = counts.toPandas().to_numpy(np.int64).reshape(-1, 3)  # at most 2 ** BITS
    sizes = {r["toxic"]: r["count"] for r in trained.groupBy("toxic").count().collect()}
    clean, toxic = (rows[:, 1] + 2) / (sizes.get(0, 0) + 4), (rows[:, 2] + 2) / (sizes.get(1, 0) + 4)
    out = np.zeros(1 << BITS, np.float32)
    out[rows[:, 0]] = np.maximum(np.log(toxic / clean), 0)
    out[0] = 0
    return out


class Shown(NamedTuple):
    """Windows of the worst sentences of documents: their symbols, label, margin and place (0: the worst)."""

    windows: np.ndarray
    toxic: np.ndarray
    margin: np.ndarray
    place: np.ndarray


def _show(trained: DataFrame, model: Model) -> Shown:
    """The worst window of each of a training document's worst sentences."""
    shared = trained.sparkSession.sparkContext.broadcast(model)

    def worst(text: str, model: Model, most: int) -> list[tuple[float, bytes]]:
        found = []
        for _, part in _parts([text]):
            symbols, begins, _ = coded(part)
            if not len(begins):
                continue
            margins = model.windows(symbols)
            begins = begins - WINDOW + 1
            best = np.maximum.reduceat(margins, begins)
            for s in np.argsort(-best, kind="stable")[:most]:
                end = begins[s + 1] if s + 1 < len(begins) else len(margins)
                at = begins[s] + int(np.argmax(margins[begins[s] : end]))
                found.append((float(best[s]), symbols[at : at + WINDOW].tobytes()))
        return sorted(found, key=lambda f: -f[0])[:most]

    def show(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found = worst(text, shared.value, SHOWN[int(toxic)])
                rows += [(window, int(toxic), margin, place) for place, (margin, window) in enumerate(found)]
            columns = list(zip(*rows)) or [[]] * 4
            types = [pa.binary(), pa.int32(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["window", "toxic", "margin", "place"]
            )

    schema = "window binary, toxic int, margin double, place int"
    rows = trained.mapInArrow(show, schema).toPandas()  # at most SHOWN[1] times TRAIN_DOCUMENTS
    rows = rows.sort_values(["window", "toxic", "margin", "place"])
    windows = np.frombuffer(b"".join(map(bytes, rows["window"])), np.uint32).reshape(-1, WINDOW)
    return Shown(windows, rows["toxic"].to_numpy() == 1, rows["margin"].to_numpy(), rows["place"].to_numpy())


def _with_insertions(windows: np.ndarray, pick: np.random.Generator) -> np.ndarray:
    """The windows, each with a letter, twice, and with a boundary put in somewhere in the middle."""
    out = [windows]
    letters = [pick.integers(97, 123, len(windows)) for _ in range(2)]
    for symbols in (*letters, np.zeros(len(windows), int)):
        at = pick.integers(3, WINDOW - 4, len(windows))
        out.append(np.array([np.insert(w, k, s)[:WINDOW] for w, k, s in zip(windows, at, symbols)], np.uint32).reshape(-1, WINDOW))
    return np.concatenate(out)


def _spread(rows: np.ndarray, most: int) -> np.ndarray:
    return rows[np.linspace(0, len(rows) - 1, min(len(rows), most)).astype(int)] if len(rows) else rows


def _fit(toxic: np.ndarray, clean: np.ndarray, seed: int) -> Model:
    """The machine over toxic windows, variants of them, and clean ones; landmarks are some of both."""
    pick = np.random.default_rng(seed)
    toxic = _with_insertions(np.unique(toxic, axis=0), pick)
    some = [_spread(pick.permutation(rows), most) for rows, most in ((toxic, LANDMARKS * 3 // 4), (clean, LANDMARKS // 4))]
    label = np.arange(len(toxic) + len(clean)) < len(toxic)
    weight = np.where(label, len(clean) / len(toxic) / 2, 1.0)
    weights, bias = fit_machine(np.concatenate([toxic, clean]), label, weight, np.concatenate(some))
    return Model(weights, bias, np.zeros(2))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The machine over sentences, and the scale of a text's score, from the training documents.

    All sentences of a clean document are clean. Which ones of a toxic document are toxic isn't said: each
    round takes those beyond the margin of the round before's machine; in the first rounds each document's
    worst one counts too. Clean documents give their worst ones, which stay while they are within the margin. The first
    round goes by the runs of four symbols that stand more often in toxic documents.
    """
    trained = kept(training_documents(docs, labels))
    model = nothing = Model(np.zeros(1 << BITS, np.float32), 0.0, np.array([-3.0, 0.0]))
    if trained.select("toxic").distinct().count() < 2:
        return nothing
    shown = _show(trained, Model(_first_weights(trained), 0.0, np.zeros(2)))
    clean = np.zeros((0, WINDOW), np.uint32)
    for turn in range(ROUNDS):
        clean = clean[model.of_windows(clean) > -1]
        clean = np.unique(np.concatenate([clean, shown.windows[~shown.toxic]]), axis=0)
        chosen = shown.toxic & ((shown.margin > 0) & (turn > 0) | (shown.place == 0) & (turn < FREE))
        if not len(clean) or not chosen.any():
            return nothing
        model = _fit(shown.windows[chosen], clean, turn)
        shown = _show(trained, model)
    return model._replace(scale=scale_of(shown.margin[~shown.toxic & (shown.place == 0)]))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every whole text.

    A null or empty text has no sentence and the lowest margin; repeated rows are scored each, null
    ids are kept, other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS numbers

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = shared.value.margins(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(shared.value.score(margins))], ["doc_id", "score"])

    return findable(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text")).mapInArrow(
        score, "doc_id long, score double"
    )


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
