import hashlib

import public_tokenizers
import pytest
import tiktoken

from grainline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tok():
    return bpe.Tokenizer.from_file(bpe._read(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(tok):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tok.ranks, special_tokens={})


TEXTS = ["", " ", "hello world", "the the the", "Ünïçödé 你好 \U0001f600!!", "a" * 1000, "ab" * 700 + " " * 300, "<|endoftext|> x",
         "loweiä\n\n\t  über 12345678901234567890", "  x\x00\x01", "'s't " * 5, "z" * 63 + " " + "y" * 64 + " " + "q" * 65]


def test_against_reference_library(tok, reference):
    for text, ids in zip(TEXTS, tok.encode_batch(TEXTS), strict=True):
        assert ids == reference.encode_ordinary(text), text
        assert tok.decode(ids) == text.encode()


def test_random_bytes_short_and_long(tok, reference):
    import random
    rng = random.Random(3)
    for size in (2, 5, 17, 64, 65, 200, 3000):
        for alphabet in ("ab", "etaoin", "é日x", "qwertyuiopasdfghjkl"):
            text = "".join(rng.choice(alphabet) for _ in range(size))
            want = reference.encode_ordinary(text)
            assert next(tok.encode_batch([text])) == want
            assert list(tok.merge_long(text.encode())) == want or len(want) == 1


def test_frame_roundtrip_with_nulls_and_repeats(spark):
    rows = [(1, "hello <|endoftext|>", "x"), (1, "hello <|endoftext|>", "x"), (None, None, None), (3, "", "y"), (4, "word " * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    got = out.collect()
    assert sorted(r.n_tokens for r in got)[:2] == [0, 0] and len(got) == 5
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.ids_sha256 == empty and r.decoded_sha256 == empty for r in got if not r.ids)
    back = bpe.decode(out, PATH).collect()
    assert sorted(r.text for r in back) == sorted((t or "") for _, t, _ in rows)
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_operator_against_library_on_given_documents(spark, sf_small, reference):
    from grainline.llm import queries
    got = {r.doc_id: r for r in queries.op2_byte_bpe(spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        ids = reference.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_a_full_cache_keeps_what_repeats(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 40)
    own = bpe.Tokenizer.from_file(bpe._read(PATH), public_tokenizers.PATTERN)
    for k in range(30):
        text = "zqxjk vwxyzq " + " ".join(f"q{chr(97 + (k * 7 + i) % 26)}z{k}w{i}" for i in range(12))
        assert next(own.encode_batch([text])) == reference.encode_ordinary(text)
        assert len(own.cache) < 300 and own.again <= set(own.cache)
    assert "zqxjk" in own.cache
    own.forget()
    assert not own.cache and not own.again
