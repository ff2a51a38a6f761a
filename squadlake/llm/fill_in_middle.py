"""Texts rearranged so that a model learns to fill in the middle, by a pyarrow.compute pipeline."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import findable, whole

SEED = 42
#: Percent of the documents that are rearranged, and of these the percent with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
#: Bytes of text that one pass of the pipeline takes; a longer text goes alone.
PASS_BYTES = 16 << 20

def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string())]
    + [("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())]
)
FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def split_units(texts: pa.Array) -> pa.LargeListArray:
    """The units of each text: white space with the word after it, or what is left at the end.

    Runs of white space and words take turns, so both are split off by the other's pattern and
    put together again; a text has one more run of white space, maybe empty, than words.
    """
    spaces, words = pc.split_pattern_regex(texts, WORD), pc.split_pattern_regex(texts, SPACE)
    parents = pc.list_parent_indices(spaces).to_numpy()
    spaces, words = pc.list_flatten(spaces), pc.list_flatten(words)
    words = words.filter(pc.greater(pc.binary_length(words), 0))
    followed = np.append(parents[1:] == parents[:-1], False) if len(parents) else np.zeros(0, bool)
    follower = pa.array(np.cumsum(followed) - 1, mask=~followed)
    units = pc.binary_join_element_wise(spaces, pc.fill_null(words.take(follower), _text("")), _text(""))
    filled = pc.greater(pc.binary_length(units), 0)
    return _listed(
        np.bincount(parents[filled.to_numpy(zero_copy_only=False)], minlength=len(texts)), units.filter(filled)
    )


def _listed(sizes: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int64()), values)


def rearranged(texts: pa.Array, hashes: list[np.ndarray], rate: int, suffix_first: int) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of each text, in one pass over all of them."""
    units = split_units(texts)
    n = pc.list_value_length(units).to_numpy().astype(np.int64)
    first, second, chosen, order = hashes
    cuts = np.stack([first % (n + 1), second % (n + 1)])
    low, high = cuts.min(axis=0), cuts.max(axis=0)

    flat, parents = pc.list_flatten(units), pc.list_parent_indices(units).to_numpy()
    ordinal = np.arange(len(flat)) - units.offsets.to_numpy()[:-1][parents]
    role = (ordinal >= low[parents]).astype(np.int8) + (ordinal >= high[parents])
    prefix, middle, suffix = (
        pc.binary_join(_listed(sizes, flat.filter(pa.array(role == number))), _text(""))
        for number, sizes in enumerate((low, high - low, n - high))
    )

    plain = pa.array((n == 0) | (chosen % 100 >= rate))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    spm = pa.array(order % 100 < suffix_first)
    p, s, m, nothing = map(_text, (PREFIX, SUFFIX, MIDDLE, ""))
    suffix_then = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
    prefix_then = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
    none = pa.scalar(None, pa.int64())
    return [
        pa.array(n),
        pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        *[pc.if_else(plain, none, pc.cast(pc.utf8_length(part), pa.int64())) for part in (prefix, middle)],
        pc.if_else(plain, texts, pc.if_else(spm, suffix_then, prefix_then)),
    ]


def _passes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most PASS_BYTES of text each, one row at least."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + PASS_BYTES, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def fill_in_middle(
    docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row for each of ``docs``.

    A text is cut into ``n`` units, white space and the word after it. Two cuts, a choice and an
    order are drawn from the hash of ``seed`` and the id, so a row's result depends on that row alone and
    a task that runs again gives the same. ``form`` is ``spm`` (suffix, prefix, middle, each after its
    mark), ``psm`` (prefix, suffix, middle) or ``plain``: the text as it is, as are those that are empty or hold a
    mark themselves. A null text is empty, a null id is hashed as no digits, repeated
    rows are kept with equal results, other columns are ignored, an empty table gives an empty result. Texts go
    through the pipeline whole, PASS_BYTES at a time.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    narrow = (
        findable(docs)
        .select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"), drawn.alias("drawn"))
        .select(
            "doc_id",
            "text",
            *[F.conv(F.substring("drawn", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)],
        )
    )

    def transform(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _passes(batch):
                texts = part["text"].cast(pa.large_string())
                hashes = [part[f"h{i + 1}"].to_numpy() for i in range(4)]
                columns = [part["doc_id"], *rearranged(texts, hashes, rate, suffix_first)]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)

    return narrow.mapInArrow(transform, FORMS)


def restored(form: Column, output: Column) -> Column:
    """The text that ``fill_in_middle`` rearranged, from what it gave.

    The marks are the only ones in ``output``: texts that hold one are plain.
    """

    def parts(*marks: str) -> list[Column]:
        at = [F.locate(mark, output) for mark in marks]
        ends = [*at[1:], F.char_length(output) + 1]
        return [F.substring(output, a + len(m), e - a - len(m)) for m, a, e in zip(marks, at, ends)]

    prefix, suffix, middle = parts(PREFIX, SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def fill_in_middle_digest(docs: DataFrame) -> DataFrame:
    """Output and restored text as hashes. Null and odd rows: see ``fill_in_middle``."""
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


FILL_IN_MIDDLE_SQL = rf"""
with units as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as unit,
           sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as drawn
    from documents),
hashed as (
    select *, len(unit) as n, cast('0x' || drawn[1:8] as bigint) as h1, cast('0x' || drawn[9:16] as bigint) as h2,
           cast('0x' || drawn[17:24] as bigint) as h3, cast('0x' || drawn[25:32] as bigint) as h4
    from units),
cut as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
           case when n = 0 or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}')
                     or h3 % 100 >= {RATE} then 'plain'
                when h4 % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form
    from hashed),
parts as (
    select *, array_to_string(list_filter(unit, lambda x, i: i <= low), '') as prefix,
           array_to_string(list_filter(unit, lambda x, i: i > low and i <= high), '') as middle,
           array_to_string(list_filter(unit, lambda x, i: i > high), '') as suffix
    from cut)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end) as output_sha256,
       sha256(prefix || middle || suffix) as restored_sha256
from parts
"""
