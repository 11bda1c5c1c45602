import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ratingsmith.llm import queries
from ratingsmith.llm import token_files as op
from tests.llm.helpers import documents
from tests.llm.test_bpe import random_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return tok


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_values_round_trip(n):
    rng = random.Random(n)
    v = np.array([rng.choice([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, rng.randrange(2**32)]) for _ in range(n)], np.uint32)
    control, data = op.pack_values(v)
    assert len(control) == -(-n // 4)
    got = op.unpack_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
    assert got.tolist() == v.tolist()


def test_shard_round_trip_and_damage():
    ids = np.array([7, 7, 7, 2, 9, 2], np.uint32)
    blob = op.shard_bytes(3, 1, [5, None, -8], np.array([3, 1, 2]), ids)
    part, seq, docs, sizes, back = op.read_shard(blob)
    assert (part, seq, docs, sizes.tolist(), back.tolist()) == (3, 1, [5, None, -8], [3, 1, 2], ids.tolist())
    for bad in (blob[:-1], b"X" + blob[1:], blob + b"0"):
        with pytest.raises(ValueError):
            op.read_shard(bad)


def want(library, rows, end):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard", [50, op.SHARD])
def test_files_hold_what_the_library_gives(spark, library, tmp_dir, shard, monkeypatch):
    texts = random_texts(5, 80, 40) + ["", None, "<|endoftext|> x", "lorem " * 40_000]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, "same id"), (3, "same id")]
    random.Random(1).shuffle(rows)
    monkeypatch.setattr(op, "SHARD", shard)
    folder = f"file://{tmp_dir}/shards"
    got = op.round_trip(documents(spark, rows).repartition(4), PATH, 2, folder=folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want(library, rows, 2)
    names = os.listdir(f"{tmp_dir}/shards")
    assert names and all(n.endswith((".bin", ".crc")) for n in names)


def test_empty_table(spark):
    got = op.round_trip(documents(spark, []), PATH, 2)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0


def test_query_gives_the_ids_of_an_unmodified_library(spark, tmp_dir):
    mark = "<|endoftext|>"
    texts = ["a b", f"a {mark} x", mark, f"{mark}{mark}\n don't", "", None, f"é  {mark[:-1]} {mark}日本 ", "<|endof", "text|> after", f"end{mark}"]
    rows = list(enumerate(texts + random_texts(7, 30, 20))) + [(None, mark)]
    documents(spark, rows).repartition(2).write.parquet(f"{tmp_dir}/added/documents.parquet")
    got = queries.QUERIES["op8_token_files"](spark, f"{tmp_dir}/added").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want(Tokenizer.from_file(PATH), rows, queries.END_ID)


def test_a_folder_takes_one_write(spark, tmp_dir):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    folder = f"{tmp_dir}/shards"
    first = op.round_trip(documents(spark, [(1, "a b"), (2, "c")]), path, 2, folder=folder)
    assert sorted(r.doc_id for r in first.collect()) == [1, 2]
    with pytest.raises(FileExistsError):
        op.round_trip(documents(spark, [(7, "x")]), path, 2, folder=folder)
    assert sorted(r.doc_id for r in first.collect()) == [1, 2]
