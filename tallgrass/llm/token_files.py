"""Token ids as flat unsigned integer files, with 64-bit document offsets.

The documents are range-partitioned and sorted by id; every task writes three
files of its own: ``.bin`` (ids, the smallest unsigned type that holds the
vocabulary and the end id, little-endian), ``.idx`` (unsigned 64-bit offsets
into it, one more than documents) and ``.doc`` (signed 64-bit document ids).
File names carry a fresh suffix per attempt and only the files of attempts
that succeed come into the manifest, so a lost executor's half-written files
are never read.  The manifest holds one row per part; partition bases
(documents and ids before a part) are the prefix sums of its counts.  Readers
map the files into memory and need no other part.

Defined results: a null or empty text is a document of the end id alone; null
ids come first (the manifest counts them per part), repeated ids and rows
keep a place each, ordered by text; extra columns are ignored; an empty table
writes no file and gives an empty result.  A task holds about ``GATHER`` bytes
of text at a time, or one longer text.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm.bpe import codec, gathered, tokenizer_path
from tallgrass.llm.common import few_arrow_rows, scratch_path

END_ID = 2
PART_BYTES = 32 << 20
PARTS_SCHEMA = "part int, file string, width int, n_docs bigint, n_nulls bigint, n_ids bigint"
ROWS_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
READ_DOCS = 50_000


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return fs, path


def _mapped(uri: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped if it is local, else read."""
    fs, path = _folder(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return np.frombuffer(f.read_buffer(), kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def write_token_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                      path: str | None = None, end_id: int = END_ID) -> list[dict]:
    """Write the files below ``folder`` (a URI all executors reach); returns the
    manifest rows with their bases, also written to ``folder/manifest``."""
    spark = docs.sparkSession
    few_arrow_rows(spark)
    path = path or tokenizer_path()
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    by = ["doc_id", F.xxhash64("text")]
    placed = own.repartitionByRange(n, *by).sortWithinPartitions(*by)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        kind = np.dtype("<u2" if max(len(c.bytes_of), end_id + 1) <= 1 << 16 else "<u4")
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        fs, root = _folder(folder)
        fs.create_dir(root, recursive=True)
        n_docs = n_nulls = n_ids = 0
        with fs.open_output_stream(f"{root}/{name}.bin") as ids_file, \
                fs.open_output_stream(f"{root}/{name}.idx") as idx, fs.open_output_stream(f"{root}/{name}.doc") as doc:
            idx.write(np.zeros(1, "<u8").tobytes())
            for keys, texts in gathered(batches):
                encoded = c.encode_batch(texts)
                lens = np.fromiter((len(x) + 1 for x in encoded), np.int64, len(encoded))
                ends = np.cumsum(lens)
                out = np.full(int(ends[-1]), end_id, kind)
                for at, x in zip(ends - lens, encoded):
                    out[at:at + len(x)] = x
                ids_file.write(out.tobytes())
                idx.write((ends + n_ids).astype("<u8").tobytes())
                doc.write(keys.fill_null(0).to_numpy().astype("<i8").tobytes())
                n_docs, n_nulls, n_ids = n_docs + len(texts), n_nulls + keys.null_count, n_ids + int(ends[-1])
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "width": kind.itemsize, "n_docs": n_docs,
                                               "n_nulls": n_nulls, "n_ids": n_ids}], schema=_parts_arrow())

    placed.mapInArrow(write, PARTS_SCHEMA).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def _parts_arrow() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()),
                      ("n_nulls", pa.int64()), ("n_ids", pa.int64())])


def read_manifest(spark: SparkSession, folder: str) -> list[dict]:
    """One row per part (as many as write tasks), with base_docs and base_ids."""
    parts = [r.asDict() for r in spark.read.schema(PARTS_SCHEMA).parquet(f"{folder}/manifest").orderBy("part").collect()]
    for name, of in (("base_docs", "n_docs"), ("base_ids", "n_ids")):
        for p, base in zip(parts, accumulate((p[of] for p in parts), initial=0)):
            p[name] = base
    return parts


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    parts = read_manifest(spark, folder)
    schema = PARTS_SCHEMA + ", base_docs bigint, base_ids bigint"
    rows = spark.createDataFrame([tuple(p.values()) for p in parts], schema).repartition(max(1, len(parts)), "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in (p for b in batches for p in b.to_pylist()):
            name = f"{folder}/{p['file']}"
            ids = _mapped(f"{name}.bin", f"<u{p['width']}")
            idx = _mapped(f"{name}.idx", "<u8").astype(np.int64)
            docs = _mapped(f"{name}.doc", "<i8")
            for a in range(0, p["n_docs"], READ_DOCS):
                b = min(a + READ_DOCS, p["n_docs"])
                crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(idx[a:b], idx[a + 1:b + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[a:b], mask=np.arange(a, b) < p["n_nulls"]), pa.array(idx[a:b] + p["base_ids"]),
                     pa.array(np.diff(idx[a:b + 1])), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(read, ROWS_SCHEMA)


def token_file_rows(docs: DataFrame, folder: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    write_token_files(docs, folder)
    return read_token_files(spark, folder)
