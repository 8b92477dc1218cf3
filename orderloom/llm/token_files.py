"""Token ids as files of Arrow streams with fixed-size-list batches."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import ship, staged
from orderloom.llm.tokens import chunks, default_vocabulary, encoder

LENGTH = 1024
#: Longer runs of texts than by default: each distinct part of them is looked up once.
CHARS_AT_ONCE = 4_000_000
ROWS_PER_BATCH = 64

#: `batches` holds where in the file each batch of ROWS_PER_BATCH sequences begins; the last may
#: have fewer, and the one before it too, since the rest of a file is padded apart.
FILES = "part int, path string, documents long, ids long, batches array<struct<offset:long,first:long,rows:int>>"


def _schema(length: int, id_type: pa.DataType) -> pa.Schema:
    """Per sequence: ids, which of them are real (the rest is padding), and which end a document."""
    flags = pa.list_(pa.bool_(), length)
    return pa.schema([("input_ids", pa.list_(id_type, length)), ("attention_mask", flags), ("document_end", flags)])


def _lists(values: np.ndarray, length: int) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values), length)


class _Writer:
    """One stream of sequences and, beside it, the ids of its documents in order."""

    def __init__(self, folder: str, part: int, attempt: int, length: int, id_type: pa.DataType):
        self._fs, base = pa.fs.FileSystem.from_uri(folder)
        self._fs.create_dir(base, recursive=True)
        self._final = [f"{base}/part-{part:06d}.{kind}.arrow" for kind in ("ids", "docs")]
        self._open = [f"{base}/_part-{part:06d}-{attempt}.{kind}" for kind in ("ids", "docs")]
        self._files = [self._fs.open_output_stream(path) for path in self._open]
        self._length, self._schema = length, _schema(length, id_type)
        self._dtype = id_type.to_pandas_dtype()
        self._docs_schema = pa.schema([("doc_id", pa.int64())])
        self._ids = pa.ipc.new_stream(self._files[0], self._schema)
        self._docs = pa.ipc.new_stream(self._files[1], self._docs_schema)
        self._rest: list[np.ndarray] = []
        self._ends: list[np.ndarray] = []
        self.batches: list[dict[str, int]] = []
        self.documents = self.ids = self._rows = 0

    def add(self, doc_ids: list[int | None], encoded: list[bytes]) -> None:
        """Append whole documents; full batches go to the file at once."""
        counts = np.fromiter((len(data) // 4 for data in encoded), dtype=np.int64, count=len(encoded))
        ids = np.frombuffer(b"".join(encoded), dtype="<u4").astype(self._dtype)
        ends = np.zeros(len(ids), dtype=bool)
        ends[np.cumsum(counts) - 1] = True
        self._docs.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64())], schema=self._docs_schema))
        self.documents += len(encoded)
        self.ids += len(ids)
        self._rest.append(ids)
        self._ends.append(ends)
        if sum(map(len, self._rest)) >= self._length * ROWS_PER_BATCH:
            self._flush(self._length * ROWS_PER_BATCH)

    def _flush(self, unit: int) -> None:
        """Write all whole units of what has gathered."""
        ids, ends = np.concatenate(self._rest), np.concatenate(self._ends)
        done = len(ids) // unit * unit
        for begin in range(0, done, self._length * ROWS_PER_BATCH):
            part = slice(begin, min(done, begin + self._length * ROWS_PER_BATCH))
            self._write(ids[part], ends[part], part.stop - part.start)
        self._rest, self._ends = [ids[done:]], [ends[done:]]

    def _write(self, ids: np.ndarray, ends: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        arrays = [_lists(x, self._length) for x in (ids, mask, ends)]
        self.batches.append({"offset": self._files[0].tell(), "first": self._rows, "rows": len(arrays[0])})
        self._rows += len(arrays[0])
        self._ids.write_batch(pa.record_batch(arrays, schema=self._schema))

    def close(self) -> str:
        """Pad and write the rest, then give the files their names, which replaces earlier attempts'."""
        if self._rest:
            self._flush(self._length)
            real = len(self._rest[0])
            if real:
                space = (0, self._length - real)
                self._write(np.pad(self._rest[0], space), np.pad(self._ends[0], space), real)
        for stream, file in zip((self._ids, self._docs), self._files, strict=True):
            stream.close()
            file.close()
        for path, final in zip(self._open, self._final, strict=True):
            self._fs.move(path, final)
        return self._final[0]


def write_token_files(
    spark: SparkSession,
    docs: DataFrame,
    folder: str,
    vocabulary: str | None = None,
    end_id: int = 2,
    length: int = LENGTH,
) -> DataFrame:
    """Encode the documents in ascending doc_id order into files below `folder`; rows of FILES.

    The ids of all documents of a file, each with the end id behind it, stand in
    sequence, `length` to a row; only the last row of a file is padded. Files in order of
    `part` hold the documents in order; rows without doc_id come first, equal doc_ids in
    order of the text's hash. A null text is an empty one and has only the end id. Each task streams
    its range of documents and holds one batch of sequences. `folder` is a URI that
    pyarrow.fs can write to and all executors share.
    """
    ship(spark)
    path = vocabulary or default_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        task = TaskContext.get()
        id_type = pa.uint16() if encoder(path).size <= 2**16 else pa.uint32()
        end = np.array([end_id], dtype="<u4").tobytes()
        writer = None
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for texts in chunks(batch.column(1), CHARS_AT_ONCE):
                writer = writer or _Writer(folder, task.partitionId(), task.taskAttemptId(), length, id_type)
                writer.add(ids[at : at + len(texts)], [data + end for data in encode(texts)])
                at += len(texts)
        if writer:
            place = pa.struct([("offset", pa.int64()), ("first", pa.int64()), ("rows", pa.int32())])
            names = {"part": pa.int32(), "path": pa.string(), "documents": pa.int64(), "ids": pa.int64(), "batches": pa.list_(place)}
            values = (task.partitionId(), writer.close(), writer.documents, writer.ids, writer.batches)
            yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, names.values(), strict=True)], list(names))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Not by the text itself: the sort samples its keys, which must stay short.
    return staged(spark, rows.orderBy("doc_id", F.xxhash64("text")).mapInArrow(write, FILES))


class Sequences:
    """Sequences of one file by their number, without reading what is before them or copying.

    `batches` is the file's entry in FILES. A file on a local disk is mapped into memory and the
    arrays that `ids` and `mask` return are views of the mapping; from another store only the
    one batch is read.
    """

    def __init__(self, path: str, batches: list, folder: str = "file:///"):
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        self._file = pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)
        self._schema = pa.ipc.open_stream(self._file).schema
        self._offsets = [at["offset"] for at in batches]
        self._firsts = [at["first"] for at in batches]
        self._count = self._firsts[-1] + batches[-1]["rows"] if batches else 0

    def __len__(self) -> int:
        return self._count

    def _column(self, sequence: int, name: str) -> pa.Array:
        if not 0 <= sequence < self._count:
            raise IndexError(f"sequence {sequence} of {self._count}")
        at = bisect_right(self._firsts, sequence) - 1
        self._file.seek(self._offsets[at])
        message = pa.ipc.read_message(self._file)
        if message.type == "schema":  # stands before a file's first batch
            message = pa.ipc.read_message(self._file)
        lists = pa.ipc.read_record_batch(message, self._schema).column(name)
        length = lists.type.list_size
        return lists.values.slice((sequence - self._firsts[at]) * length, length)

    def ids(self, sequence: int) -> np.ndarray:
        return self._column(sequence, "input_ids").to_numpy(zero_copy_only=True)

    def mask(self, sequence: int) -> pa.BooleanArray:
        """Which ids are real, one bit each as the file has them."""
        return self._column(sequence, "attention_mask")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of all documents in the files, read batch by batch.

    `start` counts the ids of all documents before, in the order of the files. The one
    global window sees one row per file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(path.replace(".ids.", ".docs.")) as file:
                    doc_ids = pa.ipc.open_stream(file).read_all().column(0).combine_chunks()
                starts, sizes, sums = [], [], []
                start, size, check = base, 0, 0
                with fs.open_input_file(path) as file:
                    for rows in pa.ipc.open_stream(file):
                        ids, mask, ends = (rows.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(3))
                        ids = ids[: int(mask.sum())].astype("<u4")
                        at = 0
                        for stop in [*(np.flatnonzero(ends) + 1).tolist(), len(ids)]:
                            check = zlib.crc32(ids[at:stop], check)
                            size += stop - at
                            if stop > at and ends[stop - 1]:
                                starts.append(start)
                                sizes.append(size)
                                sums.append(check)
                                start, size, check = start + size, 0, 0
                            at = stop
                columns = [doc_ids, *(pa.array(x, pa.int64()) for x in (starts, sizes, sums))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = files.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    spread = based.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
