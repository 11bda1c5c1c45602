"""Token-id files with frequency-ranked, byte-aligned variable-length codes (operator 8).

Texts are encoded with the ``tokenizers`` library (``add_special_tokens=False``), one
end id is appended to each document, and the ids are written in ascending document order to shard files that are
complete in themselves.

Format of a shard (little-endian): 8 bytes magic ``RSVB0001``; six uint64: task
partition, number in it, documents, ids, distinct ids, data bytes; the distinct
ids (uint32) from the most to the least frequent in the shard, ties by id; per
document its id (int64), a NULL mark (uint8) and its number of ids (uint64); the
control bytes, four 2-bit codes each (bytes of the value less one, first value
in the low bits); the data bytes, each value being the id's frequency rank in 1
to 4 bytes.  Control bytes stand apart from the data, so a decoder takes the
lengths of four values from one table row, and all of it is numpy indexing.

Encoding.  Distinct pieces of the tokenizer's own pre-tokenisation are encoded
once by the library and reused (``pretokens``); byte-level BPE never merges across
pieces, so the ids are those of whole texts.  The library cuts texts at the
tokenizer's added tokens first; a text that holds the string of one is encoded whole.
With ``added_tokens`` the ids are those of the library as it stands, which gives one id to
the string of a special token; without, such a string is ordinary text.

Scale.  One shuffle: rows are range-partitioned by document id and sorted, and
each task encodes and writes its shards of about SHARD ids.  Shards get their
final name by a rename, and a task that runs again writes the same bytes to the same names.  A folder holds
one write: ``write`` refuses a folder that has shards.  Only
shard totals (one row a shard) are summed up for the global starts, in two
levels.  Files are written through the file system of the folder's address and
read back with Spark's ``binaryFile`` source.

Defined cases.  NULL or empty text: only the end id.  NULL document ids come
first, ties are ordered by text.  A document is never cut: a very long one makes
one larger shard.  Repeated rows are documents of their own.  Empty table: no
files, empty result.  Extra columns are not written.  A folder that holds shards: FileExistsError, nothing is written.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, pretokens, words

MAGIC = b"RSVB0001"
#: Ids of one shard file, unless a single document has more.
SHARD = 2_000_000

INDEX = "part int, seq int, docs long, n_ids long, bytes long"
DOCS = "part int, seq int, place long, doc_id long, before long, n_tokens long, ids_crc32 long"


class Encoder:
    """Encodes texts by their pieces, and those that hold the string of an added token whole."""

    def __init__(self, path: str, added_tokens: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added_tokens
        self.marks = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values() if added_tokens or not t.special]
        self.pieces = pretokens.Encoder(self.library)

    def library(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all, ids of each)``."""
        got = [e.ids for e in self.tok.encode_batch_fast([p.decode("utf-8") for p in found], add_special_tokens=False)]
        count = np.array([len(x) for x in got], np.int64)
        return np.array([i for x in got for i in x], np.int32), count

    def encode(self, raw: bytes, row_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, ids per text)`` of texts joined in ``raw``."""
        if not any(m in raw for m in self.marks):
            return self.pieces.encode(raw, row_bytes)
        ends = np.cumsum(row_bytes)
        texts = [raw[a:b] for a, b in zip((ends - row_bytes).tolist(), ends.tolist(), strict=True)]
        whole = np.array([any(m in t for m in self.marks) for t in texts])
        per = np.zeros(len(texts), np.int64)
        cut, per[~whole] = self.pieces.encode(b"".join(t for t, w in zip(texts, whole, strict=True) if not w), row_bytes[~whole])
        got = [self.library([t])[0] for t, w in zip(texts, whole, strict=True) if w]
        per[whole] = [len(x) for x in got]
        ids, held = np.zeros(int(per.sum()), np.int32), np.repeat(whole, per)
        ids[~held] = cut
        if held.any():
            ids[held] = np.concatenate(got)
        return ids, per


@functools.lru_cache(maxsize=2)
def encoder(path: str, added_tokens: bool) -> Encoder:
    """One encoder for each Python worker and tokenizer file."""
    return Encoder(path, added_tokens)


def pack_values(v: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = v.astype("<u4")
    extra = (v > 0xFF).astype(np.uint8)
    extra += v > 0xFFFF
    extra += v > 0xFFFFFF
    quad = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    quad[:len(v)] = extra
    quad = quad.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


@functools.cache
def code_sizes() -> np.ndarray:
    """Control byte -> byte lengths of its four values."""
    c = np.arange(256)
    return np.stack([(c >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.int64)


def unpack_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = code_sizes()[control].ravel()[:n]
    at = np.cumsum(size) - size
    padded = np.concatenate((data, np.zeros(3, np.uint8)))
    out = np.zeros(n, np.uint32)
    for k in range(int(size.max(initial=0))):
        out |= np.where(size > k, padded[at + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def shard_bytes(part: int, seq: int, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    known, which, count = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((known, -count))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    control, data = pack_values(rank[which])
    head = np.array([part, seq, len(doc_ids), len(ids), len(known), len(data)], "<u8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join((MAGIC, head.tobytes(), known[order].astype("<u4").tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(),
                     sizes.astype("<u8").tobytes(), control, data))


def read_shard(blob: bytes) -> tuple[int, int, list[int | None], np.ndarray, np.ndarray]:
    """``(part, seq, document ids, ids per document, ids)`` of a shard; ValueError if it is not whole."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token shard")
    part, seq, docs, n, distinct, size = (int(x) for x in np.frombuffer(blob, "<u8", 6, 8))
    at = 56
    want = at + 4 * distinct + 17 * docs + -(-n // 4) + size
    if len(blob) != want:
        raise ValueError(f"token shard has {len(blob)} bytes, not {want}")
    known = np.frombuffer(blob, "<u4", distinct, at)
    at += 4 * distinct
    doc_ids = np.frombuffer(blob, "<i8", docs, at).tolist()
    null = np.frombuffer(blob, np.uint8, docs, at + 8 * docs)
    sizes = np.frombuffer(blob, "<u8", docs, at + 9 * docs).astype(np.int64)
    at += 17 * docs
    control = np.frombuffer(blob, np.uint8, -(-n // 4), at)
    data = np.frombuffer(blob, np.uint8, size, at + len(control))
    ids = known[unpack_values(control, data, n)] if n else np.zeros(0, "<u4")
    return part, seq, [None if x else d for d, x in zip(doc_ids, null, strict=True)], sizes, ids


def _put(folder: str, name: str, blob: bytes) -> None:
    files, path = pafs.FileSystem.from_uri(folder)
    held = f"{path}/.{name}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(held) as out:
        out.write(blob)
    if files.get_file_info(f"{path}/{name}").type == pafs.FileType.NotFound:
        files.move(held, f"{path}/{name}")
    else:                                    # an earlier attempt of this task wrote the same bytes
        files.delete_file(held)


def _shards(folder: str) -> bool:
    files, path = pafs.FileSystem.from_uri(folder)
    if files.get_file_info(path).type != pafs.FileType.Directory:
        return False
    return any(f.base_name.startswith("part-") for f in files.get_file_info(pafs.FileSelector(path)))


def write(df: DataFrame, folder: str, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
          added_tokens: bool = False) -> DataFrame:
    """Writes the shards when the result runs; the result has one row for each shard (INDEX)."""
    if _shards(folder):
        raise FileExistsError(f"{folder} holds token shards already; give every write a folder of its own")
    common.small_batches(df.sparkSession)
    rows = df.select(F.col(common.quoted(doc_id)).cast("long").alias("doc_id"), F.col(common.quoted(text)).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        enc = encoder(path, added_tokens)
        part, seq = TaskContext.get().partitionId(), 0
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        docs, sizes, held, count = [], [], [], 0
        index = []

        def close():
            nonlocal docs, sizes, held, count, seq
            ids = np.concatenate(held)
            blob = shard_bytes(part, seq, docs, np.concatenate(sizes), ids)
            _put(folder, f"part-{part:06d}-{seq:06d}.bin", blob)
            index.append((part, seq, len(docs), len(ids), len(blob)))
            docs, sizes, held, count, seq = [], [], [], 0, seq + 1

        for batch in batches:
            keys = batch["doc_id"].to_pylist()
            for at, n, raw, row_bytes in pretokens.raw_runs(batch["text"]):
                ids, per = enc.encode(raw, row_bytes)
                out = np.full(len(ids) + n, end_id, np.uint32)
                ends = np.cumsum(per + 1) - 1
                mark = np.ones(len(out), bool)
                mark[ends] = False
                out[mark] = ids
                docs += keys[at:at + n]
                sizes.append(per + 1)
                held.append(out)
                count += len(out)
                if count >= SHARD:
                    close()
        if count:
            close()
        cols = list(zip(*index, strict=True)) or [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         names=["part", "seq", "docs", "n_ids", "bytes"])

    return rows.mapInArrow(common.map_batches(run), INDEX)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``part, seq, place, doc_id, before, n_tokens, ids_crc32`` of every document in the files.

    ``before`` counts the ids of earlier documents of the shard.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.bin").load(folder).select("content")

    def run(batches):
        for batch in batches:
            for blob in batch["content"]:
                part, seq, docs, sizes, ids = read_shard(blob.as_buffer().to_pybytes())
                ids = ids.astype("<u4")
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends - sizes, ends, strict=True)]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, seq), pa.int32()),
                     pa.array(np.arange(n), pa.int64()), pa.array(docs, pa.int64()),
                     pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    names=["part", "seq", "place", "doc_id", "before", "n_tokens", "ids_crc32"])

    return files.mapInArrow(common.map_batches(run), DOCS)


def starts(index: DataFrame) -> DataFrame:
    """``part, seq, first``: ids in all shards before this one; summed within tasks, then over tasks."""
    whole = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    whole = whole.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("part_first"))
    inside = W.partitionBy("part").orderBy("seq")
    return (index.withColumn("inner_first", F.sum("n_ids").over(inside) - F.col("n_ids")).join(whole, "part")
            .select("part", "seq", (F.col("part_first") + F.col("inner_first")).alias("first")))


def round_trip(df: DataFrame, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
               folder: str | None = None, added_tokens: bool = False) -> DataFrame:
    """Writes all documents to ``folder`` (or a staged one) and returns what its files hold, with global starts."""
    spark = df.sparkSession
    stages = common.Stages(spark, "tokens")
    folder = folder or stages.path("files")
    index = stages.put(write(df, folder, path, end_id, text, doc_id, added_tokens), "index")
    if index.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return (read(spark, folder).join(starts(index), ["part", "seq"])
            .select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
