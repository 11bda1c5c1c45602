import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from ratingsmith.llm import bpe, pretokens
from tests.llm.helpers import documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
BITS = ["'", "s", "t", "re", "ve", "m", "ll", "d", "'s", " ", "  ", "\n", "\t", "a", "B", "é", "ß", "1", "²", "½", "٣", "_",
        "-", "!!", "日本", "😀", "\u0301", "\x85", "\xa0", "\u3000", "\x1c", "\u200b", "'S", "<|endoftext|>", "İ", "\x00"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


def random_texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_pieces_equal_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for seed in range(400):
        texts = random_texts(seed, 5, 14)
        raw = [t.encode() for t in texts]
        start, per = pretokens.pieces(b"".join(raw), np.array([len(r) for r in raw]))
        ends = np.append(start[1:], sum(map(len, raw)))
        got = [b"".join(raw)[a:b].decode() for a, b in zip(start, ends, strict=True)]
        assert got == [p for t in texts for p in pattern.findall(t)], texts
        assert per.tolist() == [len(pattern.findall(t)) for t in texts]


@pytest.mark.parametrize("keep", [5, 10**6])
def test_encoder_equals_the_library(ranks, library, keep):
    """Also when the cache of pieces is too small for one run."""
    enc = pretokens.Encoder(ranks.encode_pieces, keep)
    for seed in range(100):
        texts = random_texts(seed, 6, 25)
        raw = [t.encode() for t in texts]
        ids, per = enc.encode(b"".join(raw), np.array([len(r) for r in raw]))
        want = [library.encode_ordinary(t) for t in texts]
        assert ids.tolist() == [i for w in want for i in w]
        assert per.tolist() == [len(w) for w in want]
        assert ranks.decode(ids) == b"".join(raw)


def test_matrix_and_heap_merge_alike(ranks, library):
    rng = random.Random(4)
    for n in (1, 2, 3, 5, 40, 255, 256, 257, 600):
        for letters in ("ab", "thonanere", "zq"):
            piece = "".join(rng.choice(letters) for _ in range(n)).encode()
            m = ranks.byte_id[np.frombuffer(piece, np.uint8)][None]
            done, count = ranks.merge_matrix(m)
            assert done[0, :count[0]].tolist() == ranks.merge_long(piece)
            ids, per = ranks.encode_pieces([piece])
            assert ids.tolist() == library.encode_ordinary(piece.decode()) and per.tolist() == [len(ids)]


def test_round_trip_in_spark(spark, library):
    texts = random_texts(9, 60, 80) + ["", None, "x" * 5000, " " * 3000, ("lorem ipsum " * 50_000)]
    rows = [(i, t, None if i % 3 else "v") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long".replace("n long", "n_tokens string")).repartition(3)
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]        # the clashing column is replaced
    for r in out.collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "")
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_decode_rejects_unknown_ids(ranks):
    assert ranks.decode(np.zeros(0, np.int64)) == b""
    for bad in (50256, 10**6):
        with pytest.raises(ValueError):
            ranks.decode(np.array([0, bad]))


def test_null_ids_and_digest(spark):
    df = spark.createDataFrame([(1, None), (None, bytearray(b"\x00\x00\x00\x00"))], "doc_id long, ids binary")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, PATH).collect()}
    assert got == {1: b"", None: b"!"}
    assert hashlib.sha256(got[1]).hexdigest().startswith("e3b0c442")
    assert documents(spark, []).count() == 0
