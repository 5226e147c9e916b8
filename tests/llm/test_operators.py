"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscape.llm import ann, components, decontaminate, linededup, neardup, packing, quality, suffix, toxicity, urls, warc
from fundscape.llm import queries as Q

from . import brute

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    docs = [(k, "\n".join(words(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 5)))) for k in range(n)]
    for k in range(n, n + 20):  # copies with a few changed words
        text = docs[rng.randrange(n)][1].split(" ")
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = words(rng, 1)
        docs.append((k, " ".join(text)))
    docs += [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "One"), (905, "x" * 3000), (906, "y " * 5000), (907, docs[0][1].upper())]
    return docs


def frame(spark, docs):
    """Documents with columns whose names operators use inside."""
    rows = [(d, t, "k", 1.0, 7) for d, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, score double, n long")


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_decontamination(spark, bound):
    docs = corpus()
    items = [(1, docs[3][1]), (2, "Short item"), (3, None), (4, "..."), (5, docs[3][1]), (6, docs[8][1][:200])]
    docs += [(1000, f"{docs[50][1]} short ITEM {docs[51][1]}"), (1001, f"{words(random.Random(5), 900)} short item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.verdicts(decontaminate.decontaminate(frame(spark, docs), bench, broadcast_bytes=bound))
    got = found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("k"), F.sha2(F.concat_ws(",", "items"), 256).alias("h"), "contaminated")
    assert rows(got, *got.columns) == sorted(brute.decontaminate(docs, items), key=repr)
    if bound:
        clean = decontaminate.remove_spans(frame(spark, docs), found)
        again = decontaminate.decontaminate(clean, bench)
        assert again.where("n_hit > 0").count() == 0 and clean.columns == frame(spark, docs).columns
    kept = decontaminate.drop_contaminated(frame(spark, docs), bench)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in brute.decontaminate(docs, items) if not r[5]}


def test_empty_tables(spark):
    none, bench = frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = frame(spark, corpus()[:5])
    assert decontaminate.decontaminate(some, bench).where("n_hit > 0").count() == 0
    assert neardup.near_duplicates(none).count() == 0 and linededup.dedup_lines(none).count() == 0 and suffix.remove_repeats(none).count() == 0
    assert quality.score_quality(some, labels).where("score between 0 and 1").count() == 5
    assert toxicity.score_toxicity(some, labels).where("score between 0 and 1").count() == 5
    assert toxicity.score_toxicity(none, labels).count() == 0 and quality.score_quality(none, labels).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(warc.write_archive(warc.with_revisits(pages))).count() == 0
    assert urls.judge(pages, Q.URL_RULES).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, n):
    docs = corpus(2)
    got = neardup.near_duplicates(frame(spark, docs), shingle_words=n)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near_duplicates(docs, n), key=repr)
    kept = neardup.drop_near_duplicates(frame(spark, docs), shingle_words=n)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in brute.near_duplicates(docs, n) if r[3]}


def test_near_duplicates_of_one_large_family(spark, monkeypatch):
    """Many edits of one text, in several blocks: links that only chains reach."""
    monkeypatch.setattr(neardup, "GROUP_ROWS", 40)
    rng = random.Random(4)
    base = [words(rng, 1) for _ in range(80)]
    docs = []
    for k in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(80)] = words(rng, 1)
        docs.append((k, " ".join(text)))
    docs += [(7, docs[7][1])]  # a repeated row
    got = {(r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(frame(spark, docs), shingle_words=2).collect()}
    assert got == {(r[0], r[2]) for r in brute.near_duplicates(docs[:-1], 2)}


def test_posterior_bounds_only_fall_below_the_miss_probability():
    for n, least in neardup.least_matches(0.8, 1e-6):
        tail = lambda m: sum(np.exp(np.sum(np.log(np.arange(1, n + 2))) - np.sum(np.log(np.arange(1, k + 1))) - np.sum(np.log(np.arange(1, n + 2 - k)))) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(least) >= 1e-6 > tail(least - 1)


def test_line_dedup(spark):
    rng = random.Random(6)
    lines = [words(rng, rng.randint(12, 40)) for _ in range(40)]
    docs = []
    for k in range(60):
        text = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(lines).split(" ")
            if rng.random() < 0.4:
                line[rng.randrange(len(line))] = words(rng, 1)
            text.append(" ".join(line) if rng.random() < 0.8 else "  " + " ".join(line).upper().replace(" ", "\t", 1))
        docs.append((k, "\n".join([*text, ""])))
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "ab\nAB\nab"), (104, "z" * 20_000)]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(frame(spark, docs)).collect()}
    want = brute.dedup_lines(docs)
    wrong = [d for d in want if got[d] != want[d]]
    assert len(wrong) <= 1, wrong  # candidates are found by hashing
    assert linededup.dedup_lines(frame(spark, docs)).columns == [*frame(spark, docs).columns, "n_lines", "n_removed"]


def test_line_dedup_recall(spark):
    """Unequal pairs of similar lines, by number of words and without blanks; each kind of line has its own pairs."""
    rng = random.Random(11)
    letters = {"latin": "abcdefghijklmnopqrstuvwxyz", "cjk": "".join(map(chr, range(0x4E00, 0x5200))), "thai": "".join(map(chr, range(0xE01, 0xE2F)))}
    make = {n: lambda n=n: " ".join("".join(rng.choices(letters["latin"], k=rng.randint(3, 8))) for _ in range(n)) for n in (2, 3, 8, 9, 12, 20, 40)}
    make |= {kind: lambda a=a: "".join(rng.choices(a, k=rng.choice((14, 30, 60, 100, 200)))) for kind, a in letters.items()}
    docs, pairs = [], {}
    for kind, line in make.items():
        while len(pairs.setdefault(kind, [])) < 60:
            a = line()
            b = list(a)
            for _ in range(rng.randint(1, 3)):
                at = rng.choice((rng.randrange(len(b)), 0, len(b) - 1))
                b[at] = rng.choice(("", "7", b[at] + "7"))
            b = "".join(b)
            x, y = ({t[k : k + 5] for k in range(len(t) - 4)} for t in (a, b))
            if a != b.strip() and len(x & y) >= 0.8 * len(x | y):
                pairs[kind].append(len(docs))
                docs += [(len(docs), a), (len(docs) + 1, b)]
    docs += [(100_000, "-----"), (100_001, "-" * 9), (100_002, "=" * 40), (100_003, "=" * 7)]  # equal sets of 5-grams
    got = {r["doc_id"]: r["n_removed"] for r in linededup.dedup_lines(frame(spark, docs)).collect()}
    recall = {kind: sum(got[k + 1] for k in own) / len(own) for kind, own in pairs.items()}
    assert min(recall.values()) == 1, recall
    assert (got[100_001], got[100_003]) == (1, 1)


def test_line_dedup_recall_of_clustered_characters(spark):
    """Long lines whose anchors stand in a code at the beginning, the middle or the end, in which all edits fall; the rest has
    none, few, or as many as usual."""
    rng = random.Random(12)
    rest = {"none": "abcdefghjlpqrtuvxyz", "few": "abcdefghjlpqrtuvxyz" * 3 + "iw", "usual": "abcdefghijklmnopqrstuvwxyz", "cjk": "abcdefgh"}
    docs, pairs = [], {}
    for kind, letters in rest.items():
        while len(pairs.setdefault(kind, [])) < 40:
            own = [words_of(rng, letters, 60) for _ in range(2)]
            codes = ["".join(rng.choices("ikmw147" if kind != "cjk" else "".join(map(chr, range(0x4E00, 0x4F00))), k=24)) for _ in range(2)]
            at = rng.choice((0, len(own[0]) // 2, len(own[0])))
            a, b = (own[0][:at] + " " + code + " " + own[0][at:] for code in codes)
            x, y = ({t.strip()[k : k + 5] for k in range(len(t.strip()) - 4)} for t in (a, b))
            if len(x & y) >= 0.8 * len(x | y):
                pairs[kind].append(len(docs))
                docs += [(len(docs), a), (len(docs) + 1, b)]
    got = {r["doc_id"]: r["n_removed"] for r in linededup.dedup_lines(frame(spark, docs)).collect()}
    recall = {kind: sum(got[k + 1] for k in own) / len(own) for kind, own in pairs.items()}
    assert min(recall.values()) == 1, recall


def words_of(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(n))


def test_line_dedup_is_native(spark):
    plan = linededup.dedup_lines(frame(spark, corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (300, 200), (200, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 300: 200}
    assert got == want


@pytest.mark.parametrize("hot", [10_000, 2])
def test_repeated_strings(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    rng = random.Random(8)
    docs = [(k, words(rng, 60)) for k in range(20)]
    part = words(rng, 80)
    docs += [(100 + k, f"{words(rng, k + 3)} {part[k * 7 :]} {words(rng, 9)} {part[: 260 + k]}") for k in range(12)]
    docs += [(200, docs[3][1]), (201, None), (202, ""), (203, "é" * 400), (204, "ab" * 500), (205, "é" * 100)]
    got = suffix.remove_repeats(frame(spark, docs))
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.repeats(docs), key=repr)


def test_run_index_gives_longest_matches():
    texts = [b"abracadabra", b"cadabraca", b"zzzzzz", b"", b"abra"]
    index = suffix.RunIndex(texts)
    best = index.statistics()
    places = [(k, i) for k, t in enumerate(texts) for i in range(len(t))]
    for k, i in places:
        own = texts[k][i:]
        want = max((next((n for n in range(min(len(own), len(o)), 0, -1) if own[:n] == o[:n]), 0) for j, p in places if (j, p) != (k, i) for o in [texts[j][p:]]), default=0)
        assert best[index.first[k] + i] == want
    assert len(index.heads) < len(index.suffix)


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = [*corpus(3), (950, "It's 12 İstanbul ΣΑΣ “q” <|endoftext|> don't"), (951, "a b " * 9000)]
    out = packing.pack(frame(spark, docs), tokenizer_path=path).toPandas()
    for d, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = out[out.doc_id == d].sort_values("start")
        assert own["length"].sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        assert (own.start.to_numpy() == np.concatenate([[0], own["length"].cumsum()[:-1]])).all()
        assert [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own.itertuples()] == own.ids_crc32.tolist()
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.to_numpy() == np.concatenate([[0], s["length"].cumsum()[:-1]])).all() and s["length"].sum() <= 4096
    assert out.sequence_id.nunique() <= out["length"].sum() / 4096 * 1.05 + 2


@pytest.mark.parametrize("split", [300, 4 << 20])
def test_archives_round_trip(spark, split):
    rng = random.Random(9)
    pages = [(k, f"http://a/{k}", words(rng, 400)) for k in range(30)]
    pages += [(100 + k, None, pages[k % 3][2]) for k in range(9)] + [(200, "u\r\nX: y", None), (201, "u", ""), (202, "u", "same"), (203, "u", "same"), (None, "n", pages[4][2])]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    got = warc.read_archive(warc.write_archive(warc.with_revisits(df)), split_bytes=split).collect()
    best = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 1000:
            best[h] = max(best.get(h, -1), i)
    want = sorted(((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), best[h] if best.get(h, i) != i else None) for i, _, h in pages), key=repr)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got), key=repr) == want
    assert all(r["verified"] and (r["record_type"] == "revisit") == (r["refers_to"] is not None) for r in got)


def test_gzip_magic_inside_a_record_is_no_record(spark):
    noise = "".join(chr(c) for c in (0x1F, 0x8B, 8)) * 500 + words(random.Random(2), 300)
    df = spark.createDataFrame([(k, "u", noise + str(k)) for k in range(20)], "page_id long, url string, html string")
    assert warc.read_archive(warc.write_archive(warc.with_revisits(df)), split_bytes=64).count() == 20


def test_url_rules(spark):
    cases = {
        "http://Example.COM/en/x": ("example.com", "/en/x", "example.com/en/", "block"), "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://a.b.example.com/fr/?q": ("a.b.example.com", "/fr/", "com/", "allow"), "http://x.net/es/1#a": ("x.net", "/es/1", "net/es/", "block"), "http://xnet/es/": ("xnet", "/es/", None, None),
        "http://x.com": ("x.com", "", None, None), "http://x.com?y=/": ("x.com", "", None, None), "no scheme": ("", "", None, None), None: ("", "", None, None), "a://b.net/fr/://c.com/": ("b.net", "/fr/://c.com/", "net/fr/", "block"),
    }
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(cases)], "page_id long, url string, host string")
    got = urls.judge(df, Q.URL_RULES).orderBy("page_id").collect()
    for r, (host, path, rule, verdict) in zip(got, cases.values(), strict=True):
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ({verdict} if verdict else {"allow", "block"})


def test_url_trees_learn_labels(spark):
    rng = random.Random(3)
    make = lambda bad: f"http://h{rng.randint(0, 9)}.org/{'p' * rng.randint(1, 5)}" + (f"/{rng.randint(10**9, 10**10)}?a=1&b=2&c=3" if bad else "")
    rows_ = [(make(k % 2), "block" if k % 2 else "allow") for k in range(400)]
    labelled = spark.createDataFrame(rows_[:300], "url string, verdict string")
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows_[300:])], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, [], labelled=labelled).collect()}
    assert np.mean([got[k] == v for k, (_, v) in enumerate(rows_[300:])]) > 0.95


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[40:60] = x[0]
    rows_ = [(k, [float(v) for v in x[k]]) for k in range(600)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (1150, [None] * 16), (1200, [1.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0).toPandas()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        order = [k for k in np.lexsort((np.arange(600), -np.round(u @ u[q], 12))) if k != q][:5]
        own = got[got.query_id == q].sort_values("rank")
        hits += len(set(order) & set(own.vec_id))
        assert own["rank"].tolist() == [1, 2, 3, 4, 5] and own.score.is_monotonic_decreasing
        assert np.allclose(own.score, u[own.vec_id] @ u[q], atol=1e-12)
    assert hits >= 0.9 * 60 and got[got.query_id == 0].sort_values("rank").vec_id.tolist() == [40, 41, 42, 43, 44]


def test_few_vectors_give_all_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert rows(ann.nearest(df, F.col("vec_id") == 0), "rank", "vec_id") == [(1, 1), (2, 2)]


@pytest.mark.parametrize(("name", "label"), [("op2_quality", "quality"), ("op4_toxicity", "toxic")])
def test_classifiers_on_rows_held_out(spark, name, label):
    sf = "/root/testdata/sf0.01"
    got = Q.QUERIES[name](spark, sf).join(Q.table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got[label]).mean() > 0.9
    every = Q.QUERIES[name](spark, sf).toPandas()
    assert every.score.between(0, 1).all() and len(every) == 1000
    assert (every.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in every.doc_id]).all()


def test_disguised_words_are_restored(spark):
    text = "the worthless idiot was a loser and the loser was worthless with the idiot " * 40
    model = toxicity.language_model(frame(spark, [(1, text)]))
    for raw, plain in {"w0rthl3ss": "worthless", "1d1ot": "idiot", "l o s e r": "loser", "l.o.s.e.r": "loser", "looooser": "loser", "was": "was"}.items():
        assert toxicity.decode(raw, model) == plain
    rng = random.Random(5)
    docs = [(k, words(rng, 30) + (" idiot loser" if k % 2 else " the was")) for k in range(200)] + [(900, words(rng, 30) + " 1d1ot l.o.s.e.r"), (901, text[:40]), (902, None), (903, "")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame(spark, docs), labels).collect()}
    assert got[900]["score"] > 0.5 > max(got[902]["score"], got[903]["score"]) and {s["text"] for s in got[900]["restored"]} >= {"idiot", "loser"}
    kept = toxicity.drop_toxic(frame(spark, docs), labels)
    assert kept.columns == frame(spark, docs).columns and {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["score"] < 0.3}


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = Q.table(spark, SF, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        after = after.cache()
        if name == "line_dedup":
            want = brute.dedup_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
            got = {r["doc_id"]: r["text"] for r in after.collect()}
            assert sum(got[d] != want[d] for d in want) <= 0.02 * len(want)
        if name == "near_duplicates":
            want = brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
            assert {r["doc_id"] for r in after.collect()} == {w[0] for w in want if w[3]}
        docs = after
    assert 0 < docs.count() < before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_nearest_inside_dense_groups(spark):
    """Groups far larger than what is reranked at first, whose members share their codes, and one of all rows."""
    rng = np.random.default_rng(5)
    for x in (rng.normal(size=(3, 16))[rng.integers(0, 3, 3000)] + 0.005 * rng.normal(size=(3000, 16)), 3 + 0.05 * rng.normal(size=(3000, 16))):
        df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        got = ann.nearest(df, F.col("vec_id") % 100 == 0).toPandas()
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        hits = 0
        for q in range(0, 3000, 100):
            score = u @ u[q]
            score[q] = -2
            hits += len(set(np.argsort(-score)[:5]) & set(got[got.query_id == q].vec_id))
        assert hits >= 0.99 * 150
