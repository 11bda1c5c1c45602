"""Every stage of the corpus pipeline against a brute-force version on that stage's own input."""

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from ratingsmith.llm import bpe, common
from tests.llm.helpers import words_of
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_native import water_fill
from tests.llm.test_substring_dedup import brute as kept_texts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """Input of every stage and the last result, as rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages, out = common.Stages(spark, "test"), [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        result = stages.put(stage(spark, docs, SF), name)
        if name != "tokens":
            assert result.dtypes == docs.dtypes
        docs = result
        out.append(docs.collect())
    return dict(zip(["documents", *(n for n, _ in corpus_pipeline.STAGES)], out, strict=True))


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "passages", "mixture", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_rejects_bad_and_keeps_clean(spark, tables):
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    before, after = {r.doc_id for r in tables["documents"]}, {r.doc_id for r in tables["quality"]}
    assert after < before
    good, bad = ({d for d in before if labels.get(d) == q} for q in (1, 0))
    assert len(good & after) >= 0.97 * len(good) and len(bad & after) <= 0.1 * len(bad)
    assert {tuple(r) for r in tables["quality"]} <= {tuple(r) for r in tables["documents"]}


def test_one_document_of_each_component_stays(tables):
    rows = [(r.doc_id, r.text) for r in tables["quality"]]
    want = {c for _, c in components(rows)}
    assert sorted(r.doc_id for r in tables["near_copies"]) == sorted(want)
    assert {tuple(r) for r in tables["near_copies"]} <= {tuple(r) for r in tables["quality"]}


def test_passages_are_removed(tables):
    before = sorted(tables["near_copies"], key=lambda r: r.doc_id)
    after = {r.doc_id: r for r in tables["passages"]}
    assert len(after) == len(before)
    cut = 0
    for r, (text, _, gone) in zip(before, kept_texts([r.text for r in before], 35), strict=True):
        got = after[r.doc_id]
        assert (words_of(got.text), got.lang, got.source) == (words_of(text), r.lang, r.source)
        if gone:
            cut += 1
            assert got.n_chars == len(got.text)
        else:                                # blanks, line breaks and all
            assert (got.text, got.n_chars) == (r.text, r.n_chars)
    assert cut


def test_mixture_follows_the_targets(tables):
    sizes, taken, biggest = {}, {}, {}
    for r in tables["passages"]:
        n = len(words_of(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        biggest[r.source] = max(biggest.get(r.source, 0), n)
    rows = {tuple(r) for r in tables["passages"]}
    copies = {}
    for r in tables["mixture"]:
        assert tuple(r) in rows
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        taken[r.source] = taken.get(r.source, 0) + len(words_of(r.text))
    assert max(copies.values()) <= 3
    for source, target in water_fill(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 1.5 * biggest[source], source


def test_tokens_equal_the_library(tables):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(path).ids, special_tokens={})
    assert sorted((r.doc_id, r.text) for r in tables["tokens"]) == sorted((r.doc_id, r.text) for r in tables["mixture"])
    for r in tables["tokens"]:
        ids = library.encode_ordinary(r.text)
        assert r.n_tokens == len(ids) and bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_run_gives_the_stages_result(spark, tables):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.n_tokens) for r in got.collect()) == sorted((r.doc_id, r.n_tokens) for r in tables["tokens"])


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_odd_rows_and_clashing_names(spark):
    """NULLs, empty and repeated rows, and columns named like those that operators add."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()
    names = ["_quality", "score", "_words", "_removed", "n_words", "n_removed", "size", "target", "copies", "_copy", "row", "k", "kept", "places"]
    tail = [f"own {n}" for n in names]
    rows = [(*r, *tail) for r in docs] + [(None, None, None, None, None, *tail), (7001, "", "en", None, 0, *tail), (7002, " \n ", None, "s", 3, *tail)]
    rows += [(7003, "repeated row of six words here", "en", "s", 30, *tail)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                               + ", ".join(f"`{n}` string" for n in names))
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        got[name] = out.collect()
        if name != "tokens":
            assert out.columns == df.columns, name
            assert all(list(r)[5:] == tail for r in got[name]), name
    given = [tuple(r) for r in df.collect()]
    assert {tuple(r) for r in got["quality"]} <= set(given) and {tuple(r) for r in got["mixture"]} <= set(given)
    stay = {r.doc_id for r in got["near_copies"]}
    assert {None, 7001, 7002} <= stay and sum(r.doc_id == 7003 for r in got["near_copies"]) == 1
    assert len(got["passages"]) == len(given) == len(got["tokens"])
    nulls = [r for r in got["passages"] if r.doc_id is None]
    assert [r.text for r in nulls] == [None]
