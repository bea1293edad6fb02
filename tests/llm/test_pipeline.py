import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from grainline.llm import bagminhash, bpe, queries, sanitise

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again as the next one's input."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for i, (name, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
        if i < len(P.STAGES) - 1:
            assert docs.columns == P.DOCUMENT
    return out


def test_stage_order():
    assert [n for n, _ in P.STAGES] == ["quality rules", "near duplicates", "personal data", "mixing sources to target weights", "byte-level BPE"]


def test_quality_stage_keeps_what_its_query_keeps(spark, stages):
    kept = {r.doc_id for r in queries.op1_quality_rules(spark, SF).where("kept").collect()}
    assert {r.doc_id for r in stages["quality rules"].collect()} == kept


def test_near_duplicate_stage_keeps_one_of_each_class(spark, stages):
    before, after = stages["quality rules"], stages["near duplicates"]
    classes = {r.doc_id: r.class_id for r in bagminhash.classes(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(classes.values()))
    assert after.count() < before.count()


def test_personal_data_stage_leaves_none_and_clean_texts_alone(stages):
    before = {r.doc_id: r for r in stages["near duplicates"].collect()}
    after = stages["personal data"].collect()
    assert len(after) == len(before)
    for r in after:
        assert not sanitise.base_spans(r.text) and r.n_chars == len(r.text)
        if not sanitise.base_spans(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text


def test_mixing_stage_reaches_its_targets(stages):
    before, after = stages["personal data"].collect(), stages["mixing sources to target weights"].collect()
    words = lambda rows: sum(len(r.text.encode().split()) for r in rows)
    longest = max(len(r.text.split()) for r in before)
    assert abs(words(after) - 1.5 * words(before)) <= longest * len({r.source for r in before})
    copies = {}
    for r in after:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2


def test_tokens_stage_equals_the_library(stages):
    tok = bpe.Tokenizer.from_file(bpe._read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tok.ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages["mixing sources to target weights"].collect()}
    rows = stages["byte-level BPE"].collect()
    assert len(rows) == stages["mixing sources to target weights"].count()
    for r in rows[:200]:
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_stage_takes_empty_tables_nulls_and_extra_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, __hash long"
    odd = [(None, None, None, None, None, True, 1), (1, "", "en", "s", 0, None, 2), (1, "", "en", "s", 0, None, 2), (2, "word " * 3000, None, None, 5, None, 3)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in ([], odd):
        for i, (name, stage) in enumerate(P.STAGES):
            got = stage(spark, spark.createDataFrame(rows, schema), str(tmp_path))
            assert got.count() >= 0, name
            if i < len(P.STAGES) - 1:
                assert got.columns == P.DOCUMENT


def test_run_equals_its_stages(spark, stages):
    got = P.run(spark, SF).select("doc_id", "ids_sha256")
    want = stages["byte-level BPE"].select("doc_id", "ids_sha256")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
