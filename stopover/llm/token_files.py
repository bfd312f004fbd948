"""Token ids as Arrow files of equal-length sequences.

All ids, in ascending order of the documents, form one stream. It is cut into
parts of whole documents, one file each; a file holds record batches of two
fixed-size-list columns, ``ids`` and ``mask``. Sequence ``i`` of a file lies in
a batch and row that follow from ``i``, its ids at a fixed place in that
batch's buffer, so that a mapped file gives it without a copy. Only the last
sequence of a file is filled up; there the mask is false. Beside it lies an
Arrow file that says where each document starts.

A file's name holds its attempt, and nothing is renamed or replaced, so a task
that runs twice, or dies, never meets another's file, on any file system. The
files that count are those in the rows that the write returns.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, texts
from stopover.llm.tokens import encoder, tokenizer

# Sequences of a batch.
SEQUENCES = 512
WRITTEN = "part int, path string, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def uri(path: str) -> str:
    """A path or URI as Spark names it, as ``pyarrow`` does."""
    if "://" not in path and not path.startswith("file:"):
        return f"file://{path}"
    return re.sub("^s3[an]:", "s3:", path)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a local path."""
    return fs.FileSystem.from_uri(uri(path))


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, file, length: int, kind: pa.DataType):
        self.length, self.kind = length, kind
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = ipc.new_file(file, self.schema)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind.to_pandas_dtype()))
        self.size += len(ids)
        if self.size >= SEQUENCES * self.length:
            self.flush(SEQUENCES * self.length)

    def flush(self, step: int) -> None:
        flat = np.concatenate(self.held)
        whole = len(flat) // step * step
        for at in range(0, whole, step):
            self.batch(flat[at:at + step], np.ones(step, bool))
        self.held, self.size = [flat[whole:]], len(flat) - whole

    def batch(self, ids: np.ndarray, mask: np.ndarray) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.size:
            rest = np.concatenate(self.held)
            filled = -(-len(rest) // self.length) * self.length
            ids = np.zeros(filled, rest.dtype)
            ids[:len(rest)] = rest
            self.batch(ids, np.arange(filled) < len(rest))
        self.writer.close()


class SequenceFile:
    """Random access to the sequences of a file."""

    def __init__(self, path: str):
        system, local = opened(path)
        source = (pa.memory_map(local) if isinstance(system, fs.LocalFileSystem)
                  else system.open_input_file(local))
        self.reader = ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size

    def batch(self, number: int, column: str) -> pa.Array:
        lists = self.reader.get_batch(number).column(column)
        return lists.values.slice(lists.offset * self.length, len(lists) * self.length)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``, both views of the file if it is mapped.

        The mask has a bit for each id, so its view is Arrow's.
        """
        number, row = divmod(i, SEQUENCES)
        at = slice(row * self.length, (row + 1) * self.length)
        return (self.batch(number, "ids").to_numpy(zero_copy_only=True)[at],
                self.batch(number, "mask").slice(at.start, self.length))

    def tokens(self, start: int, count: int) -> np.ndarray:
        """``count`` ids of the file's stream from ``start`` on, across sequences."""
        step, out = SEQUENCES * self.length, []
        while count:
            number, at = divmod(start, step)
            out.append(self.batch(number, "ids").to_numpy(zero_copy_only=True)[at:at + count])
            start, count = start + len(out[-1]), count - len(out[-1])
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, np.uint32)


def id_type(path: str) -> pa.DataType:
    """The smallest type that holds every id of a tokenizer."""
    return pa.uint16() if tokenizer(path).get_vocab_size() <= 1 << 16 else pa.uint32()


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, length: int,
           end: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    part = task.partitionId()
    name = f"{folder}/part-{part:06d}-{task.taskAttemptId()}.arrow"
    system, own = opened(name)
    system.create_dir(opened(folder)[1], recursive=True)
    encode, last = encoder(path).encode, np.array([end], "<u4").tobytes()
    index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
    start = n_docs = 0
    with system.open_output_stream(own) as file, system.open_output_stream(own + ".docs") as docs:
        writer, places = SequenceWriter(file, length, id_type(path)), ipc.new_file(docs, index)
        for batch in batches:
            for rows in rows_of(batch):
                sizes = []
                for text in texts(rows.column("text")):
                    ids = np.frombuffer(encode(text) + last, "<u4")
                    writer.add(ids)
                    sizes.append(len(ids))
                starts = start + np.cumsum([0, *sizes])
                places.write_batch(pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(starts[:-1]), pa.array(sizes, pa.int64())],
                    schema=index))
                start, n_docs = int(starts[-1]), n_docs + rows.num_rows
        writer.close()
        places.close()
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([name]), pa.array([n_docs], pa.int64()),
         pa.array([start], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])


def write_token_files(docs: DataFrame, folder: str, path: str, length: int = 2048,
                      end: int = 0) -> list[dict]:
    """Write the ids of every whole text, in ascending ``doc_id`` order, ``end`` behind each.

    Null ids come first, rows of one id are ordered by a hash of their text, and
    ranges part them, even equal rows; a null text is empty, no rows make no
    documents. Returns a row for each file (part, path, documents,
    tokens), in order; their number is that of the shuffle partitions.
    """
    spark = docs.sparkSession
    on_workers(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text",
                        "xxhash64(text) hash", "monotonically_increasing_id() row")
        .repartitionByRange(tasks, "doc_id", "hash", "row")
        .sortWithinPartitions("doc_id", "hash", "row")
        .select("doc_id", "text")
        .mapInArrow(partial(_write, folder=folder, path=path, length=length, end=end), WRITTEN)
        .collect())
    return sorted((row.asDict() for row in rows), key=lambda r: r["part"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            file = SequenceFile(row["path"])
            system, local = opened(row["path"] + ".docs")
            with system.open_input_file(local) as source:
                index = ipc.open_file(source)
                for number in range(index.num_record_batches):
                    docs = index.get_batch(number)
                    starts = docs.column("start").to_numpy()
                    sizes = docs.column("n_tokens").to_numpy()
                    crcs = [zlib.crc32(file.tokens(s, n).astype("<u4").tobytes())
                            for s, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("doc_id"), pa.array(starts + row["before"]),
                         docs.column("n_tokens"), pa.array(crcs, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, written: list[dict]) -> DataFrame:
    """What the files hold, by document: place in the whole stream, tokens, crc32 of its ids."""
    on_workers(spark)
    before, rows = 0, []
    for row in written:
        if row["n_docs"]:
            rows.append((row["path"], before))
        before += row["n_tokens"]
    files = spark.createDataFrame(rows, "path string, before long")
    return files.repartition(max(1, len(rows))).mapInArrow(_read, READ)


def save_manifest(written: list[dict], folder: str) -> str:
    """Write down which files count, for readers of another session."""
    system, path = opened(f"{folder}/manifest.json")
    with system.open_output_stream(path) as file:
        file.write(json.dumps(written).encode())
    return f"{folder}/manifest.json"
