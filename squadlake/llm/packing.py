"""Documents packed into token windows, in order, by dynamic programming over cut points."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import findable, whole
from squadlake.llm.tokens import added_tokens, token_bytes, word_encoder

WINDOW = 1_024
SEPARATOR = 0
#: What a cut costs, in tokens of padding: between documents, after a sentence, anywhere else.
AFTER_DOCUMENT, AFTER_SENTENCE, ELSEWHERE = 0, 4, 24
#: Tokens planned together; the last window of a plan is opened again in the next.
BLOCK = 1 << 18

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, input_ids array<int>"
)


def choose_cuts(points: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Positions at which windows end, the last of ``points`` among them, at the least total cost.

    ``points`` ascends from above 0. A window from i to j costs the padding it needs and the
    penalty of the cut at j: ``window - (j - i)``, or nothing where its length is a power of two.
    The best start for j is the least of ``cost[i] + i`` over the last ``window`` tokens, which a
    monotone queue keeps at hand, or one of the few starts a power of two before.
    """
    at = np.concatenate([[0], points]).astype(np.int64)
    count = len(at)
    powers = 1 << np.arange(window.bit_length(), dtype=np.int64)
    powers = powers[powers < window]
    exact: dict[int, list[int]] = {}
    for power in powers:  # starts exactly a power of two before a point
        start = np.searchsorted(at, at - power)
        for j in np.flatnonzero((at >= power) & (at[np.minimum(start, count - 1)] == at - power)).tolist():
            exact.setdefault(j, []).append(int(start[j]))
    position, price = at.tolist(), [0, *penalty.tolist()]
    cost, came = [0] * count, [0] * count
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + position, index), both ascending
    for j in range(1, count):
        here = position[j]
        while position[queue[0][1]] < here - window:
            queue.popleft()
        least, best = queue[0]
        least += window - here
        for i in exact.get(j, ()):
            if cost[i] < least:
                least, best = cost[i], i
        least += price[j]
        cost[j], came[j] = least, best
        key = least + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], count - 1
    while j:
        cuts.append(position[j])
        j = came[j]
    return cuts[::-1]


@cache
def _ends_sentence() -> np.ndarray:
    table = [t.rstrip().endswith((b".", b"!", b"?")) or t.endswith(b"\n") for t in token_bytes()]
    # Added tokens have ids above the vocabulary and end no sentence.
    return np.array(table + [False] * (max(added_tokens().values(), default=-1) + 1 - len(table)))


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Where a window may end, and what it costs: ends of documents and sentences.

    Where they lie too far apart, every position a quarter of a window on is one as well.
    """
    penalty = np.full(len(ids) + 1, -1)
    penalty[np.flatnonzero(_ends_sentence()[ids]) + 1] = AFTER_SENTENCE
    penalty[doc_ends] = AFTER_DOCUMENT
    penalty[0] = -1
    points = np.flatnonzero(penalty >= 0)
    step = window // 4
    before = np.concatenate([[0], points[:-1]])
    for a, b in zip(before[points - before > step].tolist(), points[points - before > step].tolist()):
        penalty[a + step : b : step] = ELSEWHERE
    points = np.flatnonzero(penalty >= 0)
    return points, penalty[points]


class _Packer:
    """The documents of one task, in order. Holds one block of tokens, not the task's input."""

    def __init__(self, window: int, with_ids: bool):
        self.window, self.with_ids = window, with_ids
        self.sequence = TaskContext.get().partitionId() << 40
        self.docs: list[tuple] = []  # (doc_id, ids, tokens packed before)
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        self.docs.append((doc_id, ids, 0))
        self.tokens += len(ids)
        if self.tokens >= BLOCK:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[dict]:
        if not self.tokens:
            return
        left = [ids[done:] for _, ids, done in self.docs]
        ids = np.concatenate(left)
        ends = np.cumsum([len(x) for x in left])
        points, penalty = cut_points(ids, ends, self.window)
        cuts = choose_cuts(points, penalty, self.window)
        if not last and len(cuts) > 1:
            cuts.pop()
        start, at = 0, 0  # token, document
        for cut in cuts:
            offset = 0
            while start < cut:
                doc_id, whole_ids, done = self.docs[at]
                begin = int(ends[at]) - len(left[at])
                stop = min(cut, int(ends[at]))
                piece = ids[start:stop]
                yield {
                    "doc_id": doc_id, "start": done + start - begin, "length": stop - start,
                    "ids_crc32": zlib.crc32(piece.tobytes()), "doc_tokens": len(whole_ids),
                    "sequence_id": self.sequence, "offset": offset,
                    "input_ids": piece.astype(np.int32) if self.with_ids else None,
                }
                offset += stop - start
                start = stop
                if stop == ends[at]:
                    at += 1
            self.sequence += 1
        rest = self.docs[at:]
        if rest:
            begin = int(ends[at]) - len(left[at])
            rest[0] = (rest[0][0], rest[0][1], rest[0][2] + start - begin)
        self.docs, self.tokens = rest, len(ids) - start


_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("input_ids", pa.list_(pa.int32()))]
)


def pack_documents(docs: DataFrame, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, input_ids``.

    Each partition of ``docs`` is packed on its own and in its order, with no shuffle; only the
    last window of a partition is filled as it comes. Documents may be cut, at a price: see
    ``choose_cuts``. A sequence takes at most ``window`` tokens. A document's tokens are those of its text and SEPARATOR after them,
    so a null or empty text has one. The text's are those of ``tokenizers``, in which an added token such as
    ``<|endoftext|>`` is one id. Null ids are kept, repeated rows are documents of their own,
    an empty table gives an empty result, other columns are ignored. ``input_ids`` is null
    without ``with_ids``.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window, with_ids)
        encoder = word_encoder()
        out: list[dict] = []
        for batch in batches:
            for some in range(0, batch.num_rows, 256):
                part = batch.slice(some, 256)
                for doc_id, ids in zip(part["doc_id"].to_pylist(), encoder.encode_with_added(part["text"].to_pylist())):
                    out.extend(packer.add(doc_id, np.append(ids, np.uint32(SEPARATOR))))
                    if len(out) > 4_096:
                        yield pa.RecordBatch.from_pylist(out, _ARROW)
                        out = []
        out.extend(packer.flush(last=True))
        yield pa.RecordBatch.from_pylist(out, _ARROW)

    narrow = findable(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    return narrow.mapInArrow(pack, PIECES)


def packing_digest(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, with_ids=False).drop("input_ids")
