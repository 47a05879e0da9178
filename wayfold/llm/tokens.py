"""Token counts by scanning flat token files for end-of-document ids.

A token file is nothing but ids of fixed width, documents one after the other, each closed by the end-of-document id;
there is no index. Files are cut into blocks of ``BLOCK_BYTES`` by their lengths alone; tasks read their ranges and find
the separators with one vectorised comparison. Where documents begin then follows from a prefix scan over the blocks
of a file (count of separators, last separator so far), done in two levels so that no window holds more than
``CHUNK`` blocks or one row per ``CHUNK`` of them; a document may span any number of blocks.

Files are reached by URI through Arrow's file systems, on the executors, at shared places only.

Writing: ``write_token_files`` encodes texts in parallel. Every task attempt writes to a folder of its own and reports what
it finished; only reported files count, so a lost or repeated task leaves no duplicate, just a stray file.

Rows: null and empty texts are documents of no tokens. Repeated rows are documents of their own. An empty table or
an empty file has no documents; ids after the last separator form one document with ``closed`` = false; a file whose
length is no multiple of the width is an error.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wayfold.llm import textscan as ts
from wayfold.session import checkpoint, ensure_checkpoint_dir

#: Rank file of a public byte-level BPE; its ids fit 16 bits and END is free in it.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256
BLOCK_BYTES = 4 << 20
#: A token file is closed and the next one begun beyond this size.
FILE_BYTES = 256 << 20
CHUNK = 1024

# fixed value: the pattern that splits text before the merges of this kind of rank file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class Encoder:
    """Byte-level BPE, loaded once in each worker from a rank file."""

    def __init__(self, ranks: str):
        self.ranks, self.ready = ranks, None

    def __getstate__(self):
        return {"ranks": self.ranks, "ready": None}

    def __call__(self, text: str) -> list[int]:
        if self.ready is None:
            import tiktoken

            with open(self.ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            self.ready = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        return self.ready.encode_ordinary(text)


def write_token_files(docs: DataFrame, folder: str, text: str = "text", ranks: str = RANKS, end: int = END, width: int = 2, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every row's text into flat files below ``folder``; (path, length) of the finished ones, as a written table."""
    encode, kind = Encoder(ranks), f"<u{width}"
    schema = StructType([StructField("path", StringType()), StructField("length", LongType())])
    ts.bound_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = f"{folder}/{uuid.uuid4().hex}"
        fs, place = _opened(own)
        part, number, out, size = TaskContext.get().partitionId(), 0, None, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for t in batch.column(text).to_pylist():
                if out is None:
                    fs.create_dir(place, recursive=True)
                    name = f"part-{part:05d}-{number:04d}.tok"
                    out, size, number = fs.open_output_stream(f"{place}/{name}"), 0, number + 1
                ids = np.array([*(encode(t) if t else ()), end], kind)
                out.write(ids.tobytes())
                size += ids.nbytes
                if size >= file_bytes:
                    out.close()
                    done.append((f"{own}/{name}", size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{own}/{name}", size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done]), pa.array([n for _, n in done], pa.int64())], names=["path", "length"])

    return checkpoint(docs.select(text).mapInArrow(write, schema))


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of existing files, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def _separators(files: DataFrame, end: int, width: int, block_bytes: int) -> DataFrame:
    """(path, block, tokens, at): token positions of the separators in each block, counted from the start of the file."""
    block_bytes -= block_bytes % width
    last = F.expr(f"(length - 1) div {block_bytes}")
    blocks = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")).repartition("path", "block")
    schema = StructType([StructField("path", StringType()), StructField("block", LongType()), StructField("tokens", LongType()), StructField("at", ArrayType(LongType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block in zip(*(c.to_pylist() for c in batch.columns)):
                if length % width:
                    raise ValueError(f"{path}: {length} bytes are no whole number of ids")
                fs, place = _opened(path)
                with fs.open_input_file(place) as f:
                    ids = np.frombuffer(f.read_at(min(block_bytes, length - block * block_bytes), block * block_bytes), f"<u{width}")
                at = np.flatnonzero(ids == end) + block * (block_bytes // width)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([block]), pa.array([len(ids)]), pa.array([at.tolist()], pa.list_(pa.int64()))], names=schema.names)

    return blocks.mapInArrow(scan, schema)


def token_counts(files: DataFrame, end: int = END, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, doc, start, tokens, closed) for every document of the files (path, length); ``doc`` counts from 0 in its file."""
    found = checkpoint(_separators(files, end, width, block_bytes))
    some = found.select("path", "block", F.expr(f"block div {CHUNK}").alias("chunk"), "tokens", F.size("at").alias("n"), F.element_at(F.when(F.size("at") > 0, F.col("at")), -1).alias("last"))
    chunks = some.groupBy("path", "chunk").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    outer = Window.partitionBy("path").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("path", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select("path", "chunk", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n0"), F.max("last").over(outer).alias("last0"))
    scan = some.select("path", "chunk", "block", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("n1"), F.max("last").over(inner).alias("last1")).join(before, ["path", "chunk"])
    carry = scan.select("path", "block", (F.col("n0") + F.col("n1")).alias("docs"), (F.coalesce("last1", "last0", F.lit(-1)) + 1).alias("begin"))
    # a document starts after the separator before it, in this block or in an earlier one
    ends = found.where(F.size("at") > 0).join(carry, ["path", "block"])
    rows = F.transform("at", lambda x, i: F.struct((F.col("docs") + i).alias("doc"), F.when(i == 0, F.col("begin")).otherwise(F.get("at", i - 1) + 1).alias("start"), x.alias("stop")))
    closed = ends.select("path", F.explode(rows).alias("r")).select("path", "r.doc", "r.start", (F.col("r.stop") - F.col("r.start")).alias("tokens"), F.lit(True).alias("closed"))
    whole = some.groupBy("path").agg(F.sum("tokens").alias("all"), F.sum("n").alias("doc"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    tail = whole.where("start < all").select("path", "doc", "start", (F.col("all") - F.col("start")).alias("tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(tail)


def counted(docs: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Token counts of the rows of ``docs``, by way of flat token files in the shared folder."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/tokens-{uuid.uuid4().hex}"
    return token_counts(write_token_files(docs, folder, text, ranks))
