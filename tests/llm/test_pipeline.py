"""Every stage of the pipeline against a brute-force version, on its own input."""

from __future__ import annotations

import math
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from kinscore.llm.quality_rules import judge
from kinscore.llm.sentencepiece_codec import default_model

from .test_simhash_dedup import brute_components, brute_fingerprint
from .test_source_mixing import WORD, brute_targets
from .test_substring_dedup import brute as brute_substring

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and behind each stage; the whole is compared with run() below."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        made = stage(spark, docs, SMALL)
        if name != "sentencepiece":
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_quality(stages):
    want = {}
    for r in stages[0]:
        found = judge(r.text)
        if found[8]:
            want[r.doc_id] = (found[9], r.lang, r.source, len(found[9]))
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in stages[1]} == want
    assert 0 < len(want) < len(stages[0])


def test_simhash(stages):
    fps = {r.doc_id: brute_fingerprint(r.text) for r in stages[1]}
    values = sorted({*fps.values()})
    near = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    root = brute_components(values, near)
    low = {}
    for i, f in fps.items():
        low[root[f]] = min(i, low.get(root[f], i))
    assert sorted(r.doc_id for r in stages[2]) == sorted(low.values())
    texts = {r.doc_id: r.text for r in stages[1]}
    assert all(r.text == texts[r.doc_id] for r in stages[2])


def test_substring(stages):
    import hashlib

    want = {i: (n - gone, sha) for i, n, gone, sha in brute_substring([(r.doc_id, r.text) for r in stages[2]])}
    assert len(stages[3]) == len(stages[2])
    for r in stages[3]:
        words = WORD.findall(r.text)
        assert (len(words), hashlib.sha256(" ".join(words).encode()).hexdigest()) == want[str(r.doc_id)]


def test_mixing(stages):
    sizes, biggest = Counter(), Counter()
    for r in stages[3]:
        n = len(WORD.findall(r.text))
        sizes[r.source] += n
        biggest[r.source] = max(biggest[r.source], n)
    goal = brute_targets(dict(sizes))
    taken = Counter()
    for r in stages[4]:
        taken[r.source] += len(WORD.findall(r.text))
    assert all(abs(taken[s] - goal[s]) <= biggest[s] for s in sizes)
    assert max(Counter(r.doc_id for r in stages[4]).values()) <= 3
    assert {(r.doc_id, r.text) for r in stages[4]} <= {(r.doc_id, r.text) for r in stages[3]}
    assert math.isclose(sum(taken.values()), sum(sizes.values()), rel_tol=0.2)


def test_encoding(stages):
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    before = Counter((r.doc_id, r.source, tuple(sp.encode(r.text, add_eos=True))) for r in stages[4])
    assert Counter((r.doc_id, r.source, tuple(r.ids)) for r in stages[5]) == before
    assert all(r.text == sp.decode(r.ids) and r.n_tokens == len(r.ids) for r in stages[5])


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in stages[5])


def test_empty_and_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept string"
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, None, None, None, None, "a", "b"), (None, prose, "en", None, 7, "a", "b"), (2, prose, "en", "s", 7, "a", "b")]
    rows += [rows[2], (3, "", "en", "s", 0, None, None)]
    for n, data in enumerate(([], rows)):
        folder = str(tmp_path / str(n))
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in got} <= {None, 2} and (n == 0) == (not got)


def test_columns_with_dots_and_names_of_results_in_another_case(spark):
    """Every stage, and the operators behind three of them."""
    from kinscore.llm.quality_rules import quality_rules
    from kinscore.llm.sentencepiece_codec import sentencepiece_codec
    from kinscore.llm.substring_dedup import substring_dedup

    text = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(i, f"{i} {text}" if i else text, "en", "s", 9, "m", "x", "y") for i in range(3)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", "meta.k", "N_WORDS", "Ids"])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "unused")
        assert out.count() and "meta.k" in out.columns, name
    for found, gone in ((quality_rules(docs), "N_WORDS"), (substring_dedup(docs), "N_WORDS"), (sentencepiece_codec(docs), "Ids")):
        assert "meta.k" in found.columns and gone not in found.columns
        assert found.count() == 3
