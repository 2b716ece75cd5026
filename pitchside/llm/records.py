"""Token ids in length-delimited binary record files with an offset index.

A record file is a run of frames::

    u64 payload length | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of the payload

(all little-endian; masked: rotated right by 15 bits plus a constant, so that a
checksum stored inside checked data does not look like one). A payload is
``i64 doc_id | u8 bytes per id | u32 ids | ids``, two bytes an id where the vocabulary has at
most 65,536 ids, else four; an id that does not fit is refused. Beside each record file an index has one fixed-size entry per
record, ``i64 doc_id | u64 offset | u64 frame length | u32 ids``, so that any record can be read
alone, in any order.

Rows are range-partitioned and sorted by doc_id; every partition is one file in
the shared checkpoint folder, written under a name of its own and moved into place, so
a task that is lost or repeated leaves the same whole file.

Edge cases: null or empty text is a record with only the end id. A null doc_id is
written last. Rows that repeat a doc_id are records one after another. An empty table
writes no file and reads back empty. Only doc_id and text are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import kernels as K
from pitchside.llm import tokens
from pitchside.llm.common import identified, public_id
from pitchside.sources import store

HEAD = struct.Struct("<qBI")
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("n", "<u4")])
FILE_ROWS = "file string, first_id long, n_docs long, n_tokens long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def unframe(raw: bytes) -> bytes:
    (n,) = struct.unpack_from("<Q", raw)
    if struct.unpack_from("<I", raw, 8)[0] != masked(raw[:8]):
        raise ValueError("a record's length does not match its checksum")
    payload = raw[12 : 12 + n]
    if len(raw) != n + 16 or struct.unpack_from("<I", raw, 12 + n)[0] != masked(payload):
        raise ValueError("a record does not match its checksum")
    return payload


def id_width(n_ids: int) -> int:
    """Bytes that hold the ids 0 .. n_ids - 1."""
    return 2 if n_ids <= 1 << 16 else 4


def payload_of(doc_id: int, ids: np.ndarray, width: int) -> bytes:
    if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >> 8 * width):
        raise ValueError(f"an id does not fit in {width} bytes")
    return HEAD.pack(doc_id, width, len(ids)) + ids.astype(f"<u{width}").tobytes()


def ids_of(payload: bytes) -> tuple[int, np.ndarray]:
    doc_id, width, n = HEAD.unpack_from(payload)
    return doc_id, np.frombuffer(payload, f"<u{width}", n, HEAD.size).astype("<u4")


def file_system(uri: str):
    """(pyarrow file system, path) of a folder that every executor reaches."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, folder: str, vocabulary: str, end_id: int, files: int | None = None, plain_specials: bool = False) -> DataFrame:
    """Write all documents; returns one row per file. Tokens are made after the
    exchange, so the range sampling does not tokenize. Records and index entries are written run
    by run, so a task holds no more than a run of texts."""
    spark = docs.sparkSession
    width = id_width(max(tokens.vocabulary_size(vocabulary), end_id + 1))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = tokens.encoder(vocabulary, spaced=False, plain_specials=plain_specials)
        files_of, root = file_system(folder)
        files_of.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}"
        own = f"{root}/.{name}-{uuid.uuid4().hex}"
        out, at, n_docs, n_tokens, first = None, 0, 0, 0, 0
        for b in batches:
            ids_col = b.column(0).to_numpy(zero_copy_only=False)
            for t in K.runs(b.column(1)):
                if out is None:
                    out = [files_of.open_output_stream(f"{own}.{kind}") for kind in ("rec", "idx")]
                    first = int(ids_col[t.first])
                ids, off = enc.encode(t)
                parts, index = [], []
                for i in range(len(t)):
                    doc = int(ids_col[t.first + i])
                    raw = frame(payload_of(doc, np.append(ids[off[i] : off[i + 1]], np.uint32(end_id)), width))
                    index.append((doc, at, len(raw), int(off[i + 1] - off[i]) + 1))
                    parts.append(raw)
                    at += len(raw)
                out[0].write(b"".join(parts))
                out[1].write(np.array(index, INDEX).tobytes())
                n_docs += len(t)
                n_tokens += len(ids) + len(t)
        if out is None:
            return
        for stream, kind in zip(out, ("rec", "idx")):
            stream.close()
            files_of.move(f"{own}.{kind}", f"{root}/{name}.{kind}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), *[pa.array([x], pa.int64()) for x in (first, n_docs, n_tokens)]], ["file", "first_id", "n_docs", "n_tokens"])

    return identified(docs).repartitionByRange(files, "_id").sortWithinPartitions("_id").mapInArrow(work, FILE_ROWS)


def read_records(spark: SparkSession, folder: str, written: list) -> DataFrame:
    """Read record files back through their indexes, checking every frame: _id, start, n_tokens, ids_crc32.

    ``written``: the rows of ``write_records``, one per file; the tokens before each file are
    their running sum.
    """
    start, rows = 0, []
    for r in sorted(written, key=lambda r: (r["first_id"], r["file"])):
        rows.append((r["file"], start))
        start += r["n_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files_of, root = file_system(folder)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with files_of.open_input_stream(f"{root}/{name}.idx") as f:
                    index = np.frombuffer(f.read(), INDEX)
                starts = start + np.cumsum(index["n"].astype(np.int64)) - index["n"]
                with files_of.open_input_file(f"{root}/{name}.rec") as f:
                    for lo in range(0, len(index), 512):
                        part = index[lo : lo + 512]
                        crc = []
                        for e in part:
                            doc, ids = ids_of(unframe(f.read_at(int(e["length"]), int(e["offset"]))))
                            if doc != e["doc_id"] or len(ids) != e["n"]:
                                raise ValueError("a record is not the one that the index names")
                            crc.append(zlib.crc32(ids.tobytes()))
                        yield pa.RecordBatch.from_arrays([pa.array(part["doc_id"].astype(np.int64)), pa.array(starts[lo : lo + 512].astype(np.int64)), pa.array(part["n"].astype(np.int64)), pa.array(crc, pa.int64())], ["_id", "start", "n_tokens", "ids_crc32"])

    schema = "_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(rows, "file string, start long").repartition(len(rows)).mapInArrow(work, schema)


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{store.folder(spark)}/records-{uuid.uuid4().hex}"
    written = write_records(docs, folder, tokens.vocabulary("word_bpe_49k.json"), end_id=2).collect()  # one row per file
    return read_records(spark, folder, written).select(public_id(), "start", "n_tokens", "ids_crc32")

