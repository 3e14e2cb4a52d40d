"""Each operator against brute force, and on nulls, empty texts, repeated rows, extra columns and empty tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tradeweir.llm import decontaminate, fixity, near, packing, quality, scoring, suffixes, tokens, toxicity, urls, vectors
from tradeweir.llm.common import components, ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, h1 string, d int"
WORDS = [f"w{i}" for i in range(400)] + ["éè", "Ça", "ß"]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


def rows() -> list[tuple]:
    base, long = prose(1, 300), prose(2, 30_000)
    edited = base.split()
    edited[40] = "changed"
    near_copy = " ".join(edited)
    shared = prose(3, 60)
    texts = [base, base, near_copy, None, "", "one", long, shared + " " + prose(4, 90), prose(5, 50) + "\n" + shared, "é" * 150, "!!! ???"]
    out = [(i + 10, t, "en", "x", 1) for i, t in enumerate(texts)]
    return [*out, out[0], (None, prose(6, 30), None, None, None), (3, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    edges = [(5, 3), (3, 9), (9, 2), (20, 21), (21, 22), (7, 7)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys((2, 3, 5, 9), 2), **dict.fromkeys((20, 21, 22), 20), **dict.fromkeys(range(100, 141), 100)}


def test_scores_are_whole(docs, empty):
    got = scoring.score(docs, chunk_bytes=1 << 16, table_bytes=1 << 16).collect()
    again = scoring.score(docs).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)
    for a, b in zip(sorted(got, key=key), sorted(again, key=key), strict=True):
        assert (a.doc_id, a.n_words) == (b.doc_id, b.n_words)
        assert a.log_score == b.log_score or abs(a.log_score - b.log_score) < 1e-6
        assert (a.log_score is None) == (a.n_words == 0)
    assert scoring.score(empty).count() == 0


def test_fixity_finds_what_differs(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * (i % 700)) for i in range(3000)] + [(None, None, None)], "page_id long, url string, html string")
    first = fixity.warc_records(pages, 100).select("file", "offset", "page_id", "digest")
    second = first.where("page_id is null or page_id <> 77").withColumn("digest", F.when(F.col("page_id") == 1234, F.lit("bad")).otherwise(F.col("digest")))
    got = {(r.page_id, r.kind) for r in fixity.audit(first, second, 1 << 12, 4).collect()}
    assert got == {(77, "missing"), (1234, "changed")}
    assert fixity.audit(first, first).count() == 0
    assert fixity.audit(first.limit(0), first.limit(0)).count() == 0


def test_near_duplicates(docs, empty):
    got = near.near_duplicates(docs).collect()
    classes = {(r.doc_id, r.class_id) for r in got}
    assert {(10, 10), (11, 10), (12, 10), (13, 13), (14, 14), (16, 16)} <= classes
    assert sum(r.kept for r in got if r.class_id == 10) == 1
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(rows()) - 3
    assert near.keep_one(empty).count() == 0


def test_large_group_of_candidates(spark):
    base = prose(8, 200).split()
    texts = []
    for i in range(60):
        own = list(base)
        own[i * 3 % 200] = f"other{i}"
        texts.append((i, " ".join(own)))
    got = near.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), small=4)
    assert {r.class_id for r in got.collect()} == {0}


def test_large_groups_lose_no_component(spark):
    """Copies at all distances from a few texts, against all pairs; blocks far smaller than the groups."""
    texts = []
    for kind in range(3):
        own = prose(20 + kind, 120).split()
        for i in range(36):
            if i % 12 == 0:
                own = list(own)
            edited = list(own)
            for k in range(i % 6):
                edited[(i * 7 + k * 19) % 120] = f"x{i}y{k}"
            own[(i * 11) % 120] = f"drift{i}"
            texts.append(" ".join(edited))
    words = near.words_of(pa.array(texts))
    own, first = near.shingles(words)
    lists = [(own[a:b] >> np.uint64(33)).astype(np.int32) for a, b in zip(first[:-1], first[1:], strict=True)]
    least = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if least[i] != least[j] and near.near(lists[i], lists[j]):
                low, high = sorted((least[i], least[j]))
                least = [low if x == high else x for x in least]
    assert len(set(least)) > 3
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_duplicates(frame, small=2, block=3).collect()}
    assert got == dict(enumerate(least))


def test_overlaps_count_repeats():
    draw = random.Random(8)
    lists = [np.array([draw.randrange(9) for _ in range(draw.randrange(1, 40))], np.int32) for _ in range(12)]
    got = near.overlaps(lists, piece=7)
    for i, x in enumerate(lists):
        for j, y in enumerate(lists):
            assert got[i, j] == (Counter(x.tolist()) & Counter(y.tolist())).total()
            assert near.common_length(x, y) <= got[i, j]


def test_texts_with_a_common_passage_stay_apart(spark):
    """Candidates by a long shared passage are regrouped by rare shingles; only real near copies are found."""
    passage = prose(7, 60)
    texts = [f"{prose(100 + i, 30)} {passage} {prose(300 + i, 30)}" for i in range(60)]
    texts += [t + " tail" for t in texts[:9]] + [f"{passage} end{i}" for i in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_duplicates(frame, small=2, star=3, block=4).collect()}
    assert got == {i: i if i < 60 else i - 60 if i < 69 else 69 for i in range(89)}


def test_alignment_is_exact():
    draw = random.Random(3)
    for _ in range(200):
        a = [draw.randrange(30) for _ in range(draw.randrange(1, 50))]
        b = [x for x in a if draw.random() > 0.08] + [draw.randrange(30) for _ in range(draw.randrange(3))]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        n = table[-1, -1]
        assert near.near(np.array(a), np.array(b)) == bool(b and n >= 0.8 * (len(a) + len(b) - n) - 1e-9)


def test_decontamination_both_ways(spark, docs, empty):
    long = rows()[6][1].split()
    items = [(1, " ".join(long[500:530])), (2, prose(3, 60)), (2, "one"), (3, None), (4, "..."), (None, prose(6, 30)), (5, "w1 w2 w3 nowhere")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    small = decontaminate.decontaminate(docs, benchmark)
    large = decontaminate.decontaminate(docs, benchmark, small_bytes=0)
    got = sorted(map(str, small.collect()))
    assert got == sorted(map(str, large.collect()))
    hit = {r.doc_id: r for r in small.collect()}
    assert hit[16].n_hit >= 30 and hit[17].n_hit == 60 and hit[15].n_hit == 1 and hit[None].n_hit == 30
    assert hit[None].n_items == 0 and hit[17].items_sha256 == hashlib.sha256(b"2").hexdigest()
    for size in (0, 1 << 24):
        clean = decontaminate.keep_clean(docs, benchmark, small_bytes=size)
        assert clean.columns == docs.columns
        assert clean.count() == small.where("not contaminated").count()
        assert decontaminate.keep_clean(empty, benchmark, small_bytes=size).count() == 0
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).where("contaminated").count() == 0


def brute_repeats(texts: list[tuple]) -> dict:
    seen: set[bytes] = set()
    out = {}
    for doc, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        runs = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(bytes(b for b, x in zip(data, gone, strict=True) if not x)).hexdigest())
    return out


def test_repeats(spark, docs, empty):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = sorted((r.doc_id, r.text) for r in unique.collect())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(unique).collect()}
    assert got == brute_repeats(texts)
    assert suffixes.remove_repeats(docs).count() == len(rows())
    assert suffixes.remove_repeats(empty).count() == 0


def test_repeats_with_a_crowded_line(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 3)
    line = prose(9, 20)
    texts = [(i, prose(20 + i, 12) + line + prose(50 + i, 12) + ("\0a" * 70 if i % 3 else "")) for i in range(40)]
    got = suffixes.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(5))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == brute_repeats(texts)


def test_repeats_at_a_hot_anchor_are_dealt_out(spark, monkeypatch):
    """No task merges more suffixes of one anchor than HOT, and windows across its edges are still found."""
    monkeypatch.setattr(suffixes, "HOT", 8)
    merged, line = [], prose(9, 40)
    whole = suffixes._suffix_runs
    monkeypatch.setattr(suffixes, "_suffix_runs", lambda joined, *a: merged.append(joined) or whole(joined, *a))
    texts = [(i, prose(70 + i, 12) + line + prose(500 + i // 2, 12) + ("" if i % 3 else line[:130])) for i in range(40)]
    frame = spark.createDataFrame([*texts, texts[5]], "doc_id long, text string").repartition(5)
    got = suffixes.remove_repeats(frame)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == brute_repeats(texts)
    places = [r["first"] for x in merged[0].collect() for r in x.rows or () if not r["hot"]]
    hot = [r for x in merged[0].collect() for r in x.rows or () if r["hot"]]
    assert len(hot) > 8 and len(places) < len(hot) + len(places)


def test_loser_tree_sorts_and_knows_prefixes():
    draw = random.Random(4)
    runs, everything, base = [], [], 0
    for _ in range(7):
        own = sorted(bytes(draw.choice(b"ab") for _ in range(draw.randrange(1, 9))) for _ in range(draw.randrange(1, 30)))
        runs.append(suffixes.Run(*suffixes.front_code(own), base))
        base += len(own)
        everything += own
    order, shared = suffixes.merge(runs)
    merged = [everything[i] for i in order]
    assert merged == sorted(everything)
    assert all(n == suffixes.common(a, b, 0) for a, b, n in zip(merged, merged[1:], shared[1:], strict=False))


def test_tokens_equal_the_tokenizer():
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab's dtrevlm \n\t é1²_-<|>") for _ in range(draw.randrange(30))) for _ in range(3000)]
    texts += ["don't we're I'll 'stop'", "'", "", "x<|endoftext|>y", "<|endoftext|>"]
    own = Tokenizer.from_file(TOKENIZER)
    ids, first = tokens.vocabulary(TOKENIZER).ids(texts)
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == own.encode(text, add_special_tokens=False).ids


def test_packing(docs, empty):
    own = Tokenizer.from_file(TOKENIZER)
    got = packing.pack_documents(docs, TOKENIZER).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows()}
    long = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 16)
    ids = np.array([*own.encode(rows()[6][1], add_special_tokens=False).ids, 0], "<u4")
    assert [x[3] for x in long] == [zlib.crc32(ids[s : s + n].tobytes()) for _, s, n, _ in long]
    assert sum(x[2] for x in long) == len(ids) and all(x[2] == 2048 for x in long[1:])
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        assert sum(n for _, n in placed) <= 2048
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(placed), sorted(placed)[1:], strict=False)) and min(placed)[0] == 0
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_quality_and_toxicity(spark, docs, empty):
    draw = random.Random(5)
    data, labels = [], []
    for i in range(600):
        bad, toxic = i % 3 == 0, i % 5 == 0
        text = " ".join(["JUNK!!"] * 30) if bad else prose(1000 + i, draw.randrange(5, 60))
        data.append((i, text + (" vile" if toxic else "")))
        labels.append((i, int(not bad), int(toxic)))
    data = spark.createDataFrame(data, "doc_id long, text string").union(docs.select("doc_id", "text").where("doc_id is null"))
    labels = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    scores = quality.classify(data, labels.select("doc_id", F.col("quality").alias("y"))).join(labels.dropna(), "doc_id")
    assert scores.where("held_out and predicted <> quality").count() <= 4
    assert scores.where("score < 0 or score > 1").count() == 0
    found = toxicity.predict(data, labels.select("doc_id", (1 - F.col("quality")).alias("junk"), F.col("toxic").alias("bad")), ["junk", "bad"])
    both = found.join(labels.dropna().select("doc_id", F.col("toxic").alias("y")), "doc_id")
    assert both.where("toxic <> y").count() <= 6
    none = labels.limit(0).select("doc_id", F.col("quality").alias("y"))
    assert len({r.score for r in quality.classify(docs, none).collect()}) == 1
    assert quality.keep_good(empty, none).count() == 0
    assert toxicity.predict(docs, labels.limit(0).withColumnRenamed("toxic", "t"), ["t"]).where("toxic = 1").count() == 0


def test_rare_toxic_words_are_kept_beside_many_junk_words(spark):
    """5,400 features of junk words, all better by their z, take no places from the words that make texts toxic."""
    draw = random.Random(11)
    name = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    junk, vile, data = [name() for _ in range(1800)], [name() for _ in range(54)], []
    for i in range(900):
        own = [junk[(i // 10 * 240 + k) % 1800] for k in range(240)] if i % 10 == 0 else [prose(3000 + i, 20)]
        data.append((i, " ".join([*own, *(vile[(i // 10 * 3 + k) % 54] for k in range(3) if i % 10 == 5)]), int(i % 10 == 0), int(i % 10 == 5)))
    frame = spark.createDataFrame(data, "doc_id long, text string, junk int, bad int")
    chain = toxicity.fit(frame.select("doc_id", "text"), frame.drop("text"), ["junk", "bad"])
    learned = Counter(w for i, text, _, bad in data if bad and zlib.crc32(str(i).encode()) % 3 != 1 for w in text.split()[-3:])
    often = [w for w in vile if learned[w] >= 3]
    assert len(often) > 20 and len(chain.kept) > 4096
    assert set(toxicity.features(pa.array(often))[1].tolist()) <= set(chain.kept.tolist())


def test_a_model_is_fitted_alike_in_blocks(monkeypatch):
    """A task fits one model, out of blocks of rows; earlier categories come from models that did not see the row."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 40, 300)
    column, y = rng.integers(0, 200, sizes.sum()).astype(np.int32), (rng.random(300) < 0.3).astype(float)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    rows = toxicity.pd.DataFrame({"doc_id": range(300), "fold": rng.integers(0, 3, 300), "bad": y})
    rows["columns"] = [column[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    earlier = [[rng.normal(size=201) for _ in range(3)]]
    whole = toxicity.train(rows, "bad", earlier, 200)
    monkeypatch.setattr(toxicity, "BLOCK", 500)
    assert np.allclose(toxicity.train(rows, "bad", earlier, 200), whole, atol=1e-3)
    unseen = [toxicity.probability(earlier[0][f][c].sum() + earlier[0][f][200]) for f, c in ((f, column[a:b]) for f, a, b in zip(rows["fold"], ends[:-1], ends[1:], strict=True))]
    assert np.allclose(toxicity.logistic(sizes, column, 200, np.array(unseen)[:, None], y), whole, atol=1e-3)


def test_urls(spark):
    texts = spark.createDataFrame([("casino win big free cheap flower garden",)] * 50, "text string")
    urls_ = ["http://a.example.com/en/1", "http://WWW.example.com/en/1?x", "https://b.net/fr/", None, "nothing", "http://casinowin.org/a", "http://flowergarden.org/a/b#c", "http://x.com"]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, texts).collect()}
    assert [got[i].rule for i in range(8)] == ["example.com/en/", "www.example.com/en/", "net/fr/", None, None, None, None, None]
    assert got[5].host_words == ["casino", "org", "win"] and got[5].verdict == "block"
    assert got[6].host_words == ["flower", "garden", "org"] and got[6].verdict == "allow"
    assert (got[3].host, got[4].path, got[6].path) == ("", "", "/a/b")
    assert urls.judge(pages.limit(0), texts).count() == 0


@pytest.mark.parametrize("block", [40, 4096])
def test_vectors(spark, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 16)).astype(np.float32)
    x = np.concatenate([x, x[:40] + rng.normal(scale=0.07, size=(40, 16)), x[:10], np.tile(x[3], (30, 1)) + rng.normal(scale=0.02, size=(30, 16))]).astype(np.float32)
    data = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [1.0, None], [], [1.0, 2.0], [2.0, 4.0]]
    data += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<float>, n int"), block=block).collect()}
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(1, keepdims=True))
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        root = np.minimum(root, np.where(linked, root[None, :], len(x)).min(1))
    want = {i: (int(linked[i].sum()), int(root[i]), bool(root[i] == i)) for i in range(len(x))}
    want |= {1000 + i: (0, 1000 + i, True) for i in range(5)} | {1005: (1, 1005, True), 1006: (1, 1005, False)}
    assert got == want
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_keeps_columns(spark, docs):
    for _, stage in corpus_pipeline.STAGES[1:3]:
        assert stage(spark, docs, "").columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5
