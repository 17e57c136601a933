"""Token ids in Arrow files of equal-length sequences.

A data set is a set of shards. The token stream of a shard, all its documents in ascending order of
id, is cut into sequences of one length; a shard is two Arrow files:

* ``*.ids.arrow``: record batches of ``ids`` (fixed-size list of uint16, or uint32 for larger
  vocabularies) and ``mask`` (fixed-size list of bool; false where the last sequence is padded).
  Every batch but the last holds the same number of sequences, so sequence i is found by arithmetic
  and is read from the mapped file without a copy.
* ``*.docs.arrow``: id, start and n_tokens of each document within the stream of its shard.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.encoding import WINDOW_BYTES, text_groups, worker_encoder
from tidemark.llm.files import file_system
from tidemark.session import scratch_dir, stored

SEQUENCE = 2048
BATCH_SEQUENCES = 256

MANIFEST = "shard int, ids_path string, docs_path string, n_docs long, n_tokens long, n_sequences long"


class ShardWriter:
    """Writes one shard; the ids arrive in any portions."""

    def __init__(self, root: str, shard: int, id_type: pa.DataType, wide: bool, length: int):
        self.fs, folder = file_system(root)
        self.fs.create_dir(folder, recursive=True)
        # A repeated attempt of the task writes other files; the manifest names the ones that count.
        self.name = f"{shard:06d}-{uuid.uuid4().hex}"
        self.root, self.shard, self.length = root.rstrip("/"), shard, length
        self.item = np.dtype(np.uint32 if wide else np.uint16)
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(self.item), length)),
                ("mask", pa.list_(pa.bool_(), length)),
            ]
        )
        self.docs_schema = pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        folder = folder.rstrip("/")
        self.ids_out = self.fs.open_output_stream(f"{folder}/{self.name}.ids.arrow")
        self.docs_out = self.fs.open_output_stream(f"{folder}/{self.name}.docs.arrow")
        self.ids_file = pa.ipc.new_file(self.ids_out, self.schema)
        self.docs_file = pa.ipc.new_file(self.docs_out, self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, ids: pa.Array, tokens: np.ndarray, counts: np.ndarray) -> None:
        most = np.iinfo(self.item).max
        if len(tokens) and tokens.max() > most:
            raise ValueError(f"token id {tokens.max()} is over {most}; write with wide=True")
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.docs_file.write_batch(
            pa.record_batch([ids, pa.array(starts), pa.array(counts)], schema=self.docs_schema)
        )
        self.held.append(tokens.astype(self.item))
        self.n_held += len(tokens)
        self.n_tokens += len(tokens)
        self.n_docs += len(counts)
        if self.n_held >= self.length * BATCH_SEQUENCES:
            self._flush(self.length * BATCH_SEQUENCES)

    def _flush(self, portion: int) -> None:
        stream = np.concatenate(self.held) if self.held else np.zeros(0, self.item)
        whole = len(stream) - len(stream) % portion
        for at in range(0, whole, portion):
            self._write(stream[at : at + portion], portion)
        self.held, self.n_held = [stream[whole:]], len(stream) - whole

    def _write(self, part: np.ndarray, real: int) -> None:
        mask = np.zeros(len(part), bool)
        mask[:real] = True
        arrays = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (part, mask)
        ]
        self.ids_file.write_batch(pa.record_batch(arrays, schema=self.schema))
        self.n_sequences += len(part) // self.length

    def close(self) -> dict:
        self._flush(self.length * BATCH_SEQUENCES)
        if self.n_held:
            last = self.held[0]
            padded = np.zeros(-(-len(last) // self.length) * self.length, self.item)
            padded[: len(last)] = last
            self._write(padded, len(last))
        for each in (self.ids_file, self.docs_file, self.ids_out, self.docs_out):
            each.close()
        return {
            "shard": self.shard,
            "ids_path": f"{self.root}/{self.name}.ids.arrow",
            "docs_path": f"{self.root}/{self.name}.docs.arrow",
            "n_docs": self.n_docs,
            "n_tokens": self.n_tokens,
            "n_sequences": self.n_sequences,
        }


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None = 0,
    wide: bool = False,
    length: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all texts as token shards; the result is the manifest, one row for each shard.

    Rows are dealt to shards by ranges of the id (rows with one id by their text's hash), so shard
    order is id order, null first. ``wide`` stores ids as uint32, for vocabularies over 65,536;
    without it an id that does not fit raises.
    Null and empty texts hold ``end_id`` alone; repeated rows are written each; other columns are
    not read; an empty table gives an empty manifest. A task that is repeated after a loss writes
    new files, and only the files of the attempt that Spark committed are in the manifest.
    """
    root = scratch_dir(docs.sparkSession, "tokens")
    picked = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
        .select("id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        writer = None
        for batch in batches:
            if writer is None:
                shard = TaskContext.get().partitionId()
                writer = ShardWriter(root, shard, batch.column(0).type, wide, length)
            for row, data, offsets in text_groups(batch.column(1), WINDOW_BYTES):
                tokens, counts = encoder.ids_of(data, offsets)
                if end_id is not None:
                    tokens = np.insert(tokens, np.cumsum(counts), end_id)
                    counts = counts + 1
                writer.add(batch.column(0).slice(row, len(counts)), tokens, counts)
        if writer is not None:
            yield pa.RecordBatch.from_pylist([writer.close()], schema=manifest_schema)

    manifest_schema = pa.schema(
        [("shard", pa.int32()), ("ids_path", pa.string()), ("docs_path", pa.string())]
        + [(name, pa.int64()) for name in ("n_docs", "n_tokens", "n_sequences")]
    )
    return stored(picked.mapInArrow(write, MANIFEST), "token-manifest")


def open_mapped(uri: str) -> pa.ipc.RecordBatchFileReader:
    """An Arrow file, mapped where the file system is local, so that reading copies nothing."""
    system, path = file_system(uri)
    source = pa.memory_map(path) if system.type_name == "local" else system.open_input_file(path)
    return pa.ipc.open_file(source)


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``i`` of an open shard, without reading the sequences before it."""
    first = reader.get_batch(0).num_rows
    batch, row = reader.get_batch(i // first), i % first
    width = batch.schema.field("ids").type.list_size
    ids = batch.column("ids").flatten().slice(row * width, width)
    mask = batch.column("mask").flatten().slice(row * width, width)
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def read_token_files(manifest: DataFrame, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, from the files of a manifest.

    ``start`` counts the ids of all documents before, over all shards. One task reads one shard at
    a time, batch by batch.
    """
    # One row for each shard, so this window holds few rows however large the data is.
    based = manifest.withColumn(
        "base",
        F.coalesce(
            F.sum("n_tokens").over(
                Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
    spark = manifest.sparkSession
    spread = based.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.select(["ids_path", "docs_path", "base"]).to_pylist():
                yield from _shard_digests(shard["ids_path"], shard["docs_path"], shard["base"])

    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    return spread.mapInArrow(read, schema).withColumnRenamed("id", id_col)


def _shard_digests(ids_path: str, docs_path: str, base: int) -> Iterator[pa.RecordBatch]:
    reader, docs = open_mapped(ids_path), open_mapped(docs_path)
    at, held, next_batch = 0, np.zeros(0, "<u4"), 0  # held: the stream from token ``at`` on
    for d in range(docs.num_record_batches):
        part = docs.get_batch(d)
        starts, counts = (part.column(name).to_numpy() for name in ("start", "n_tokens"))
        digests = np.zeros(len(starts), np.int64)
        for k, (start, count) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
            crc, left = 0, count
            while left:
                if start >= at + len(held):
                    at += len(held)
                    held = reader.get_batch(next_batch).column("ids").flatten().to_numpy().astype("<u4")
                    next_batch += 1
                    continue
                piece = held[start - at : start - at + left]
                crc = zlib.crc32(piece, crc)
                start, left = start + len(piece), left - len(piece)
            digests[k] = crc
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(starts + base), pa.array(counts), pa.array(digests)],
            names=["id", "start", "n_tokens", "ids_crc32"],
        )


def token_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The manifest written earlier to ``path``."""
    return spark.read.schema(MANIFEST).parquet(path)
