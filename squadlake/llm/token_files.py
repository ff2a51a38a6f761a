"""Token ids as flat files of unsigned integers with 64-bit document offsets, read back by mapping them.

A folder holds, for each part, in ascending order of the documents' ids:

``<part>.ids``      the ids of all its documents, little-endian, 2 or 4 bytes each
``<part>.docs``     the integer id of each document, 8 bytes
``<part>.lengths``  the number of ids of each document, 8 bytes
``<part>.offsets``  where each document begins among the ids of all parts, and where the last one ends, 8 bytes

``parts`` and ``manifest`` are Parquet tables of one row for each part. A part's name is drawn anew by each
attempt of a task and only those in the manifest count, so that an attempt that was lost or ran twice does no harm.
The folder must be one that all executors reach by the same URI.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from squadlake.llm.common import findable, whole
from squadlake.llm.tokens import added_tokens, token_bytes, tokenizer
from squadlake.session import shared_folder

END_ID = 0
#: White space in the sense of the vocabulary's pattern.
WHITE_SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\pZ]"
#: Words whose ids a worker keeps at most, and words given to the library as one text.
KEPT_WORDS, JOINED_WORDS = 800_000, 200
#: Documents encoded at once, and ids a reader holds at once.
TEXTS, IDS = 1_024, 1 << 20

PARTS = "part int, name string, documents long, null_ids long, tokens long, width int"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, input_ids array<long>"


class LibraryWords:
    """Encodes batches of texts by ``tokenizers``, each distinct word once.

    No token reaches over a space that stands alone before a word, so there texts may be cut without changing ids.
    Texts with two white spaces in a row, or with an added token, are encoded whole.
    """

    def __init__(self):
        self.opens = np.array([t.startswith(b" ") for t in token_bytes()])
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        alone = pc.match_substring_regex(texts, WHITE_SPACE + "{2}")
        for token in added_tokens():
            alone = pc.or_(alone, pc.match_substring(texts, token))
        words = pc.split_pattern(texts.filter(pc.invert(alone)), " ")
        coded = pc.list_flatten(words).dictionary_encode()
        begins = words.offsets.to_numpy()[:-1]
        spaced = pc.binary_join_element_wise(" ", coded.dictionary, "")
        first = _strings(coded.dictionary.take(coded.indices.take(pa.array(begins))))
        if len(self.index) > KEPT_WORDS:
            self.clear()
        # Only the last word of a text can end with white space, and then the library needs it alone.
        ends_white = pc.match_substring_regex(spaced, WHITE_SPACE + "$")
        self._add_joined(_strings(spaced.filter(pc.invert(ends_white))))
        self._add_alone([*_strings(spaced.filter(ends_white)), *first])
        at = self._found(_strings(spaced))[coded.indices.to_numpy()]
        at[begins] = self._found(first)
        start, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)]
        cut = iter(np.split(ids, ends[begins[1:] - 1]) if len(begins) else ())
        return [
            np.array(_library_ids(text.as_py()), np.uint32) if whole_text else next(cut)
            for text, whole_text in zip(texts, alone.to_pylist())
        ]

    def _found(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def _add_joined(self, words: list[str]) -> None:
        """Words with a space before them, many in a call: each begins with the one token that has the space."""
        new = [w for w in words if w not in self.index]
        ids, sizes = [], []
        for some in (new[i : i + JOINED_WORDS] for i in range(0, len(new), JOINED_WORDS)):
            ids.append(np.array(_library_ids("".join(some)), np.uint32))
            opened = np.flatnonzero(self.opens[ids[-1]])
            assert len(opened) == len(some)
            sizes.append(np.diff(np.append(opened, len(ids[-1]))))
        self._append(new, ids, sizes)

    def _add_alone(self, words: list[str]) -> None:
        new = list(dict.fromkeys(w for w in words if w not in self.index))
        ids = [np.array(_library_ids(w), np.uint32) for w in new]
        self._append(new, ids, [np.array([len(x) for x in ids], np.int64)])

    def _append(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        if words:
            self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
            self.flat = np.concatenate([self.flat, *ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _library_ids(text: str) -> list[int]:
    return tokenizer().encode_batch_fast([text], add_special_tokens=False)[0].ids


@cache
def _words() -> LibraryWords:
    """One for each worker process."""
    return LibraryWords()


def byte_bpe(texts: pa.Array) -> list[np.ndarray]:
    """The ids of each text under the 50k byte-level vocabulary, added tokens as one id."""
    return _words().encode(texts)


def id_width(ids: int) -> int:
    """Bytes of an id, where there are ``ids`` of them."""
    return 2 if ids <= 1 << 16 else 4


def place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def mapped(uri: str, dtype: str) -> Callable[[int, int], np.ndarray]:
    """Entries of a file by position: a memory map where the file system has one, ranged reads elsewhere."""
    system, path = place(uri)
    file = pa.memory_map(path) if isinstance(system, pa.fs.LocalFileSystem) else system.open_input_file(path)
    size = np.dtype(dtype).itemsize

    def entries(start: int, stop: int) -> np.ndarray:
        file.seek(start * size)
        return np.frombuffer(file.read_buffer((stop - start) * size), dtype)

    return entries


def _one_task_each(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One row for each part, each in a task of its own."""
    return findable(rows).repartition(max(rows.count(), 1))


def write_token_files(
    docs: DataFrame,
    folder: str,
    encode: Callable[[pa.Array], list[np.ndarray]] = byte_bpe,
    end_id: int = END_ID,
    width: int | None = None,
) -> DataFrame:
    """Write the ids of all ``docs`` below ``folder``, ``end_id`` after each; gives the manifest.

    Documents lie in ascending order of ``doc_id``, null ids first, rows of one id by their text's hash. Texts are
    dealt by range over all three of id, hash and row, so that no id, however often repeated, fills a task. Each
    task writes its part as it encodes and holds one batch. Parts learn where they begin by a prefix sum over their totals,
    and offsets are written from there. A null or empty text has the end id alone; other columns are ignored;
    an empty table gives an empty manifest, as do tables whose folder was never written to.
    """
    spark = docs.sparkSession
    width = width or id_width(tokenizer().get_vocab_size())
    stored = f"<u{width}"

    def write_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        name, lengths, doc_ids, nulls, out = uuid.uuid4().hex, [], [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}.ids")
                encoded = [np.append(ids, end_id).astype(stored) for ids in encode(some["text"])]
                out.write(np.concatenate(encoded).tobytes())
                lengths.extend(map(len, encoded))
                nulls += some["doc_id"].null_count
                doc_ids.append(some["doc_id"].fill_null(0).to_numpy())
        if out is None:
            return
        out.close()
        sizes = np.array(lengths, "<u8")
        for kind, values in (("lengths", sizes), ("docs", np.concatenate(doc_ids).astype("<i8"))):
            with system.open_output_stream(f"{root}/{name}.{kind}") as file:
                file.write(values.tobytes())
        row = [TaskContext.get().partitionId(), name, len(sizes), nulls, int(sizes.sum()), width]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
            names=["part", "name", "documents", "null_ids", "tokens", "width"],
        )

    def write_offsets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = mapped(f"{folder}/{row['name']}.lengths", "<u8")(0, row["documents"])
                offsets = row["base"] + np.append(0, np.cumsum(lengths, dtype=np.uint64))
                with system.open_output_stream(f"{root}/{row['name']}.offsets") as file:
                    file.write(offsets.astype("<u8").tobytes())
            yield batch

    order = ["doc_id", "_text_hash", "_row"]
    ordered = (
        findable(docs)
        .select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
        .withColumns({"_text_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    ordered.mapInArrow(write_part, PARTS).write.parquet(f"{folder}/parts")
    # A row for each part: a window without keys sees no more than that.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.schema(PARTS).parquet(f"{folder}/parts")
    based = parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    schema = f"{PARTS}, base long"
    _one_task_each(spark, based).mapInArrow(write_offsets, schema).write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, input_ids`` of each document in the files below ``folder``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is that of the ids as little-endian
    32-bit integers; ``input_ids`` is null without ``with_ids``. A task maps one part and reads IDS at a time.
    """
    manifest = spark.read.schema(f"{PARTS}, base long").parquet(f"{folder}/manifest")

    def read_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            place = f"{folder}/{row['name']}"
            ids, offsets = mapped(f"{place}.ids", f"<u{row['width']}"), mapped(f"{place}.offsets", "<u8")
            doc_ids, first = mapped(f"{place}.docs", "<i8"), 0
            while first < row["documents"]:
                # As many documents as fit, one at least.
                ahead = offsets(first, min(first + 4_096, row["documents"]) + 1).astype(np.int64)
                count = max(int(np.searchsorted(ahead, ahead[0] + IDS, "right")) - 1, 1)
                ends = ahead[: count + 1]
                block = ids(int(ends[0]) - row["base"], int(ends[-1]) - row["base"]).astype("<u4")
                cuts = ends - ends[0]
                null = np.arange(first, first + count) < row["null_ids"]
                listed = pa.nulls(count, pa.list_(pa.int64()))
                if with_ids:
                    listed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(block.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids(first, first + count), mask=null),
                        pa.array(ends[:-1]),
                        pa.array(np.diff(cuts)),
                        pa.array([zlib.crc32(block[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], pa.int64()),
                        listed,
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "input_ids"],
                )
                first += count

    return _one_task_each(spark, manifest).mapInArrow(read_part, DOCUMENTS)


def token_files_digest(docs: DataFrame) -> DataFrame:
    """What the files hold of each document, without the ids. Null and odd rows: see ``write_token_files``."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, folder)
    return read_token_files(spark, folder, with_ids=False).drop("input_ids")
