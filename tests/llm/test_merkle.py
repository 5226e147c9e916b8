"""Manifests, proofs and tampered leaves against a plain tree; block layout against enumeration."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscape.llm import merkle
from fundscape.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        a = i // 16 * 16
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 16])))
        i //= 16
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) by the contract."""
    hashed = lambda *v: H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v))
    by = defaultdict(list)
    for d, s, lang, n, t in rows:
        leaf = hashed(d, s, lang, n, t)
        hit = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        by[s].append((d is not None, d or 0, leaf, hashed(d, s, lang, n, t and t.translate(LOW)) if hit else leaf))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s])]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (known, d, leaf, node) in enumerate(sorted(by[s])):
            steps = path(trees[s], i) + path(top, k)
            for a, b in steps:
                node = H(a + node + b)
            out.append((d if known else None, leaf, trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


def proofs(docs, height):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    m = merkle.build_manifest(docs, height=height, carried={"tampered": tampered})
    found = merkle.prove(m, height=height).withColumn("root", m.root.scalar())
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path"), merkle.fold(F.coalesce("tampered", "leaf"), "path").alias("f")).withColumn("v", F.col("f") == F.col("root"))
    return sorted((tuple(r) for r in found.collect()), key=str)


def documents():
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "en", i, f"Text {i}") for i in range(900)]
    rows += [(None, None, None, None, None), (None, "s1", "en", 3, ""), (5, "s5", "en", 1, "A"), (5, "s5", "en", 1, "A"), (5, "s5", "fr", 1, "B"), (7, "é", "en", 9, "Ä" * 70_000), (8, "Ω", None, None, "x"), (9, "", "en", 1, "y")]
    return rows


@pytest.mark.parametrize("height", [1, 2, 3, 4, 5])
def test_layout_gives_every_run_its_own_place(height):
    runs = np.concatenate([merkle.run_address(height, d, np.arange(16**d)) for d in range(height)])
    assert sorted(runs) == list(range(0, merkle.span(height), 16))
    if height > 1:  # the upper half comes first, and lower subtrees lie one after another
        upper = height // 2
        assert max(int(merkle.run_address(height, d, np.arange(16**d)).max()) for d in range(upper)) < merkle.span(upper)
        assert int(merkle.run_address(height, upper, 1) - merkle.run_address(height, upper, 0)) == merkle.span(height - upper)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_proofs_against_plain_trees(spark, height):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tree", "2 AS place", "3 AS _n", "4 AS leaf")
    got = proofs(docs, height)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 273])
def test_runs_of_all_sizes(spark, n):
    rows = [(i, "a", "en", 1, str(i)) for i in range(n)]
    assert proofs(spark.createDataFrame(rows, SCHEMA), 1 if n > 100 else 2) == brute(rows)


def test_proofs_of_some_leaves_only(spark):
    m = merkle.build_manifest(spark.createDataFrame(documents(), SCHEMA))
    some = merkle.prove(m, m.leaves.where("doc_id in (3, 450)"))
    root = m.root.first()["root"]
    assert [r["f"] for r in some.select(merkle.fold("leaf", "path").alias("f")).collect()] == [root, root]


def test_empty_table(spark):
    m = merkle.build_manifest(spark.createDataFrame([], SCHEMA))
    assert m.root.collect() == [] and merkle.prove(m).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = QUERIES["op12_merkle"](spark, sf).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
