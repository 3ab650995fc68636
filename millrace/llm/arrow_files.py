"""Token ids as Arrow files of fixed-size-list batches, and reading them back.

The documents' ids, each with its end id, are one stream in ascending order of the document
id, cut into shards by ranges of ids. A shard is two Arrow IPC files in a folder:

* `<shard>-sequences.arrow`: record batches of `ids`, fixed_size_list<uint16 or uint32>[length],
  and `mask`, fixed_size_list<bool>[length]: true for a token, false for the padding of the
  shard's last sequence, a bit each. Every sequence has the same number of bytes, so sequence i of a memory-mapped
  file is a slice of a batch's buffer, without a copy (`open_sequences`).
* `<shard>-documents.arrow`: `id`, `start` (its first token in the shard), `tokens`.

The manifest, one row per shard and written by Spark, says which files are the result: files
of attempts that were lost are in no manifest. The folder may be on any file system that
Arrow knows by its URI.

Null texts are empty: the end id alone. Null ids come first. Rows of one id are ordered by
their text's hash. Empty tables give no shards.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.tokens import encoded, id_type
from millrace.session import run_dir, written

#: Texts of a shard, about, in bytes.
SHARD_BYTES = 32 << 20
#: Sequences per record batch.
BATCH_SEQUENCES = 256


def qualified(spark, folder: str) -> str:
    """The folder as Spark's file systems name it: a path without a scheme is in the default one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class _Shard:
    """The two files of a shard while they are written."""

    def __init__(self, folder: str, length: int, kind: np.dtype, id_kind: pa.DataType):
        system, path = _system(folder)
        system.create_dir(path, recursive=True)
        self.name = uuid.uuid4().hex
        self.length, self.kind = length, kind
        self.sequences_schema = pa.schema([
            ("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length)),
        ])
        self.documents_schema = pa.schema([("id", id_kind), ("start", pa.int64()), ("tokens", pa.int64())])
        self.streams = [system.open_output_stream(f"{path}/{self.name}-{x}.arrow") for x in ("sequences", "documents")]
        self.sequences = pa.ipc.new_file(self.streams[0], self.sequences_schema)
        self.documents = pa.ipc.new_file(self.streams[1], self.documents_schema)
        self.held: list[np.ndarray] = []
        self.waiting = self.tokens = self.rows = self.count = 0

    def add(self, ids: pa.Array, texts: list[np.ndarray]) -> None:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.documents.write_batch(pa.record_batch([ids, pa.array(starts), pa.array(sizes)], schema=self.documents_schema))
        self.tokens += int(sizes.sum())
        self.rows += len(texts)
        for text in texts:
            self.held.append(text.astype(self.kind))
            self.waiting += len(text)
            if self.waiting >= BATCH_SEQUENCES * self.length:
                self._write(False)

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.kind)
        step = BATCH_SEQUENCES * self.length
        whole = len(flat) if last else len(flat) - len(flat) % step
        for at in range(0, whole, step):
            part = flat[at : min(at + step, whole)]
            valid = len(part)
            part = np.concatenate([part, np.zeros(-valid % self.length, self.kind)])
            mask = np.arange(len(part)) < valid
            arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask)]
            self.sequences.write_batch(pa.record_batch(arrays, schema=self.sequences_schema))
            self.count += len(part) // self.length
        self.held, self.waiting = [flat[whole:]], len(flat) - whole

    def close(self) -> tuple[str, int, int, int]:
        self._write(True)
        for x in (self.sequences, self.documents, *self.streams):
            x.close()
        return self.name, self.rows, self.tokens, self.count


def write_arrow(docs: DataFrame, tokenizer: str, folder: str, length: int = 2048, end_id: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents' ids below `folder`; the manifest: shard, file, documents, tokens, sequences."""
    chosen = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("tie", F.xxhash64("text"))
    size = chosen.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shards = max(1, chosen.rdd.getNumPartitions(), -(-size // SHARD_BYTES))
    dealt = chosen.repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie").drop("tie")
    end = np.array([end_id], dtype=np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = None
        for batch in batches:
            shard = shard or _Shard(folder, length, id_type(tokenizer), batch.column(0).type)
            for low in range(0, batch.num_rows, 2048):
                texts = encoded(batch.column(1).slice(low, 2048), tokenizer)
                shard.add(batch.column(0).slice(low, 2048), [np.concatenate([ids, end]) for ids in texts])
        if shard:
            row = [TaskContext.get().partitionId(), *shard.close()]
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "file", "documents", "tokens", "sequences"), row))])

    manifest = dealt.mapInArrow(write, "shard bigint, file string, documents bigint, tokens bigint, sequences bigint")
    return written(manifest, "arrow_manifest")


def open_sequences(folder: str, file: str) -> pa.ipc.RecordBatchFileReader:
    """A shard's sequences, memory-mapped where the file system can: batches are views of the file."""
    system, path = _system(f"{folder}/{file}-sequences.arrow")
    local = system.type_name == "local"
    return pa.ipc.open_file(pa.memory_map(path) if local else system.open_input_file(path))


def _tokens(folder: str, file: str) -> Iterator[np.ndarray]:
    reader = open_sequences(folder, file)
    for at in range(reader.num_record_batches):
        batch = reader.get_batch(at)
        ids, mask = batch.column(0).flatten().to_numpy(), batch.column(1).flatten()
        yield ids[: mask.true_count]


def read_documents(manifest: DataFrame, folder: str, id_kind) -> DataFrame:
    """(id, start, tokens, ids_crc32) of every document, from the files.

    `start` counts the tokens of all documents before it; `ids_crc32` is over its ids as
    little-endian unsigned 32-bit numbers.
    """
    along = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(along), F.lit(0))).select("file", "base")
    shards = max(1, manifest.count())
    schema = StructType().add("id", id_kind).add("start", "long").add("tokens", "long").add("ids_crc32", "long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                system, path = _system(f"{folder}/{file}-documents.arrow")
                documents = pa.ipc.open_file(system.open_input_file(path))
                stream = _tokens(folder, file)
                held, low = np.empty(0, np.uint16), 0
                for number in range(documents.num_record_batches):
                    part = documents.get_batch(number)
                    crcs = []
                    for start, tokens in zip(part.column(1).to_numpy(), part.column(2).to_numpy()):
                        crc, at, end = 0, int(start), int(start + tokens)
                        while at < end:
                            if at >= low + len(held):
                                low += len(held)
                                held = next(stream)
                            piece = held[at - low : end - low]
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                            at += len(piece)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(part.column(1).to_numpy() + base), part.column(2), pa.array(crcs, pa.int64())], names=schema.names
                    )

    return based.repartition(shards).mapInArrow(read, schema)


def new_folder(spark) -> str:
    return qualified(spark, f"{run_dir(spark)}/arrow-{uuid.uuid4().hex}")
