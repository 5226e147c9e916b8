"""Spelling variants against brute force; neighbourhoods against enumeration."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from fundscape.llm import spelling
from fundscape.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def counted(rows, one_in=199):
    c = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{d}:{w}".encode())
            if d is not None and h % one_in == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def brute(v, ratio=5):
    by = defaultdict(list)  # words one edit apart are alike before or after their middle, up to one place
    for w in v:
        h = len(w) // 2
        for k in {("a", w[:h]), ("a", w[: h - 1]), ("a", w[: h + 1]), ("z", w[h:]), ("z", w[h + 1 :]), ("z", w[h - 1 :])}:
            by[k].append(w)
    near = {w: set() for w in v}
    for some in by.values():
        for a, b in itertools.combinations(some, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in v:
        b = min(near[w], key=lambda x: (-v[x], x), default=None)
        form[w] = b if b and v[b] >= ratio * v[w] else None
    out = []
    for w in v:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, v[w], len(near[w]), v[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("symbols", [1, 2, 5])
def test_neighbourhood_is_complete(symbols):
    """All strings one edit away over an alphabet that has a letter for each symbol."""
    letters = {int(spelling._symbols(spelling._letters(c), symbols)[0]): c for c in "abcdefghijklmnopqrstuvwxyz"}
    assert len(letters) == symbols
    for word in ("abcxyz", "aaaa", "q"):
        edits = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i + k :] for k in (0, 1) for i in range(len(word) + 1 - k) for c in letters.values()}
        assert set(spelling.neighbourhood(word, symbols)) == {spelling.reduced_hash(w, symbols) for w in edits}


@pytest.mark.parametrize("symbols", [1, 3, 5, 12])
def test_variants_against_brute_force(spark, symbols):
    rng = random.Random(symbols)
    v = {}
    for _ in range(250):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        v[w] = rng.choice([5, 6, 25, 25, 130, 700])
    vocab = spark.createDataFrame(list(v.items()), "word string, n long").selectExpr("*", "1 AS reduced", "2 AS key", "'x' AS root")
    assert found(spelling.variants(vocab, symbols=symbols)) == brute(v)


def test_chains_ties_and_long_words(spark):
    long = "ab" * 40_000
    v = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 625, "zzzzzz": 5, "zzzzza": 30, "zzzzzb": 30, long: 5, long + "c": 50, "éééééé": 7}
    got = {r[0]: r for r in found(spelling.variants(spark.createDataFrame(list(v.items()), "word string, n long")))}
    assert got["abcdef"][1:3] == ("abcdefg", "abcdefghi") and got["abcdefghi"][1:3] == (None, "abcdefghi")
    assert got["zzzzzz"] == ("zzzzzz", "zzzzza", "zzzzza", 5, 2, 30)
    assert got[long][1] == long + "c" and got["éééééé"][4] == 0


def test_occurrences(spark):
    rows = [(i, "Variété variété ÀBCDEFG abc×def naïve-ness " * 3) for i in range(400)] + [(None, "variété " * 5), (1, None), (1, ""), (1, "short"), (2, "x" * 200_000), (3, "Repeat repeats"), (3, "Repeat repeats")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'w' AS word", "1 AS n")
    got = {r["word"]: r["n"] for r in spelling.vocabulary(spelling.noisy_words(docs)).collect()}
    assert got == counted(rows) and "Àbcdefg" in got and "abc×def" in got


def test_empty_tables(spark):
    assert found(spelling.variants(spark.createDataFrame([], "word string, n long"))) == []
    assert spelling.noisy_words(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_spelling"](spark, sf)) == brute(counted(rows))
