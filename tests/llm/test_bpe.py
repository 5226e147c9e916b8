"""Encoding by overlapping chunks against the library on whole texts; decoding against the texts."""

import base64
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from fundscape.llm import bpe
from fundscape.llm.queries import QUERIES

HOW = {"ranks_path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


@pytest.fixture(scope="module")
def whole():
    with open(HOW["ranks_path"], "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=HOW["pattern"], mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def expected(whole, rows):
    ids = [whole(t or "") for _, t in rows]
    return sorted((str(d), len(x), struct.pack(f"<{len(x)}I", *x), (t or "").encode()) for (d, t), x in zip(rows, ids, strict=True))


def found(df):
    return sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in df.collect())


def texts():
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("aab  \n\t'sre1,é中.  ' 're'll<|endoftext|>") for _ in range(rng.randint(0, 300)))) for i in range(120)]
    rows += [(200, None), (200, ""), (None, "x" * 500), (None, "y z" * 100), (5, " " * 900 + "a"), (6, "don't " * 100), (6, "don't " * 100), (7, "漢字" * 200), (8, "'" * 200 + "re")]
    return rows


@pytest.mark.parametrize(("chunk", "overlap"), [(4, 4), (16, 16), (40, 12), (64, 8), (1 << 15, 256)])
def test_chunks_give_the_ids_of_whole_texts(spark, whole, chunk, overlap):
    docs = spark.createDataFrame(texts(), "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS part", "3 AS no")
    encoded = bpe.encode(docs, chunk=chunk, overlap=overlap, **HOW)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    assert found(bpe.decode(encoded, **HOW)) == expected(whole, texts())


def test_long_runs_and_long_texts(spark, whole):
    rows = [(1, " " * 2_000_000 + "a"), (2, "ab cd, " * 60_000), (3, "q" * 300_000)]
    encoded = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), **HOW)
    got = {r["doc_id"]: r for r in bpe.decode(encoded, **HOW).collect()}
    assert all(bytes(got[d]["decoded"]).decode() == t for d, t in rows)
    for d in (2, 3):
        assert list(struct.unpack(f"<{got[d]['n_tokens']}I", bytes(got[d]["ids"]))) == whole(rows[d - 1][1])


def test_too_small_an_overlap_is_refused(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    with pytest.raises(ValueError, match="overlap"):
        bpe.encode(docs, chunk=10, overlap=3, **HOW)


def test_empty_table_and_unknown_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, **HOW), **HOW).collect() == []
    bad = spark.createDataFrame([(1, 1, bytearray(struct.pack("<I", 60_000)))], "doc_id long, n_tokens long, ids binary")
    with pytest.raises(Exception, match="rank file"):
        bpe.decode(bad, **HOW).collect()


def test_query(spark, whole):
    import hashlib

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((d, n, hashlib.sha256(i).hexdigest(), hashlib.sha256(t).hexdigest()) for d, n, i, t in ((int(d), n, i, t) for d, n, i, t in expected(whole, rows)))
    got = QUERIES["op11_bpe"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == want
