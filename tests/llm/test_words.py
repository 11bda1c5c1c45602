"""Words that collide under plain polynomials must be told apart."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ratingsmith.llm import bpe, jaccard_join, pretokens, queries, substring_dedup, token_files, words
from tests.llm.helpers import documents


def thue_morse(n, letters="ab"):
    word = "".join(letters[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans(letters, letters[::-1]))


def hashed(*texts):
    buf = np.frombuffer(" ".join(texts).encode(), np.uint8)
    s, e, h = words.word_hashes(buf)
    assert [buf[a:b].tobytes().decode() for a, b in zip(s, e, strict=True)] == list(texts)
    return h


@pytest.mark.parametrize("n", [64, 256, 512, 1024, 2048, 4096])
def test_thue_morse_words_differ(n):
    for letters in ("ab", "az", "é1"):
        assert len(set(hashed(*thue_morse(n, letters)).tolist())) == 2


def test_hash_depends_on_the_bytes_only():
    some = ["a", "ab", "abcdefgh", "abcdefghi", "x" * 255, "x" * 256, "x" * 257, "x" * 1000, "é" * 20]
    alone = [hashed(w)[0] for w in some]
    assert hashed(*some).tolist() == alone and len(set(alone)) == len(some)
    assert hashed(*some[::-1]).tolist() == alone[::-1]
    buf = np.frombuffer("abcdefgh\0\0".encode(), np.uint8)
    a = words.span_hashes(buf, np.array([0, 0, 0]), np.array([8, 9, 10]))
    assert len(set(a.tolist())) == 3                       # padding is no content


def test_encoder_tells_pieces_of_one_hash_apart(monkeypatch):
    """Even if the first hash of all pieces were the same."""
    real = words.span_hashes
    monkeypatch.setattr(words, "span_hashes", lambda buf, s, e, which=0: real(buf, s, e, which) * np.uint64(which))
    ids = lambda found: (np.array([b for p in found for b in p], np.int32), np.array([len(p) for p in found]))
    enc = pretokens.Encoder(ids)
    for text in ("aaa bbb ccc", "aaa", "bbb", "aaa", "ccc bbb"):
        got, per = enc.encode(text.encode(), np.array([len(text)]))
        assert bytes(got.tolist()).decode() == text and per.tolist() == [len(text)]


def test_operators_on_colliding_words(spark):
    a, b = thue_morse(1024, "ab")
    c, d = thue_morse(4096, "cd")
    texts = [a, b, c, d]
    path = queries.tokenizer_file("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(path).ids, special_tokens={})
    rows = documents(spark, list(enumerate(texts))).coalesce(1)
    for r in bpe.decode(bpe.encode(rows, path), path).collect():
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(texts[r.doc_id]))
        assert bytes(r.decoded).decode() == texts[r.doc_id]
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    for r in token_files.round_trip(rows, queries.tokenizer_file("byte_bpe_50k.json"), 2).collect():
        assert r.n_tokens == len(tok.encode(texts[r.doc_id], add_special_tokens=False).ids) + 1
    # neither linked nor removed: 35 words that differ in one colliding word only
    lead = " ".join(f"w{i}" for i in range(34))
    pair = documents(spark, [(1, f"{lead} {a}"), (2, f"{lead} {b}"), (3, a), (4, b)])
    assert {r.component_id for r in jaccard_join.join(pair).collect() if r.doc_id > 2} == {3, 4}
    kept = {r.doc_id: r.text for r in substring_dedup.remove_repeats(pair).collect()}
    assert hashlib.sha256(kept[1].encode()).digest() == hashlib.sha256(f"{lead} {a}".encode()).digest() and kept[2] == f"{lead} {b}"
