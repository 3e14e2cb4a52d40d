"""Token files, conversation repair and periodic runs against plain Python."""

import hashlib
import heapq
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeweir.llm import cycles, packing, tokens, turns, wavelet
from tradeweir.llm.common import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, path string, start int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# ---- operator 11


def long_text(n: int) -> str:
    draw = random.Random(n)
    pieces = ["word", "Größe", " 字。字", "12.5", "don't", "<|endoftext|>", "\n\n", "  x", "|", "'s", "a"]
    return "".join(draw.choice([" ", ""]) + draw.choice(pieces) for _ in range(n))


def token_rows() -> list[tuple]:
    texts = ["one two", None, "", long_text(3000), "one two", "<|endoftext|> it's", "é" * 50, "   \n"]
    rows = [(i * 3 % 8 + 5, t, "en", "p", 1) for i, t in enumerate(texts)]
    return [*rows, rows[0], (5, "other", None, None, None), (None, "none", None, None, None), (None, None, None, None, None)]


def expected_tokens(rows: list[tuple], end: int = 2) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [[*tokenizer.encode(text or "", add_special_tokens=False).ids, end] for _, text, *_ in rows]


@pytest.mark.parametrize("shard,part", [(1 << 20, 1 << 20), (257, 200)])
def test_tokens_come_back_from_files(spark, shard, part, tmp_path):
    rows = token_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    manifest = wavelet.write_shards(docs, TOKENIZER, str(tmp_path), shard=shard, part=part)
    got = wavelet.read_documents(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    want = Counter((r[0], len(ids), zlib.crc32(np.array(ids, "<u4"))) for r, ids in zip(rows, expected_tokens(rows), strict=True))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert manifest.count() == len(list(tmp_path.glob("*.wavelet"))) and manifest.agg(F.max("n_tokens")).first()[0] <= shard
    assert manifest.agg(F.sum("n_tokens")).first()[0] == sum(n * k for (_, n, _), k in want.items())
    every = Counter(i for ids in expected_tokens(rows) for i in ids)
    tokens = [2, 50256, 0, 198, 49999]
    assert {r.token: r.n for r in wavelet.count_tokens(manifest, tokens).collect()} == {t: every[t] for t in tokens}
    found = sorted(r.place for r in wavelet.find_token(manifest, 2).collect())
    assert set(found) >= {r.start + r.n_tokens - 1 for r in got} and len(found) == every[2]


def test_pieces_of_a_text_in_parts(spark):
    text = long_text(4000)
    frame = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string")
    order = ["doc_id", "piece"]
    whole, parts = (packing.pieces(frame, TOKENIZER, 500, part=n).orderBy(*order).collect() for n in (1 << 20, 150))
    assert whole == parts and len(whole) > 10


def test_no_documents_no_files(spark):
    manifest = wavelet.write_shards(spark.createDataFrame([], DOCS), TOKENIZER)
    assert manifest.count() == 0 and wavelet.read_documents(manifest).count() == 0


def test_parts_of_a_long_text_have_the_ids_of_the_whole():
    text = long_text(4000)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    parts = list(tokens.text_parts(text, 100))
    assert "".join(parts) == text and len(parts) > 50
    assert [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids
    assert list(tokens.text_parts("x" * 500, 100)) == ["x" * 500]


@pytest.mark.parametrize("n,kinds,block", [(1, 1, 64), (5000, 1, 64), (5000, 2, 512), (4097, 700, 512), (3000, 70000, 1024)])
def test_shard_answers(n, kinds, block, tmp_path):
    draw = np.random.default_rng(n + kinds)
    ids = (draw.zipf(1.3, n) % kinds).astype(np.uint32)
    path = tmp_path / "one.wavelet"
    path.write_bytes(wavelet.build(ids, [None, 7], np.array([0, n // 2]), 0, block))
    shard = wavelet.open_shard(str(path))
    assert shard.doc_ids == [None, 7] and shard.starts.tolist() == [0, n // 2]
    assert shard.tokens().tolist() == ids.tolist()
    places = draw.integers(0, n, 50)
    assert shard.access(places).tolist() == ids[places].tolist()
    assert shard.tokens(n // 3, n // 3 + n // 40).tolist() == ids[n // 3 : n // 3 + n // 40].tolist()
    for token in [*np.unique(ids)[:20].tolist(), kinds + 5]:
        where = np.flatnonzero(ids == token)
        assert shard.find(token).tolist() == where.tolist()
        assert shard.find(token, 1, 2).tolist() == where[1:3].tolist()
        a, b = sorted(draw.integers(0, n + 1, 2).tolist())
        assert shard.count(token, a, b) == int(((where >= a) & (where < b)).sum())
    with pytest.raises(IndexError):
        shard.access([n])


def test_shard_is_small(tmp_path):
    draw = np.random.default_rng(1)
    ids = (draw.zipf(1.5, 200_000) % 50_000).astype(np.uint32)
    assert len(wavelet.build(ids, [1], np.array([0]), 0)) < 1.6 * len(ids)
    with pytest.raises(ValueError):
        wavelet.Shard(pa.BufferReader(b"something else"))


# ---- operator 12


def faults_of(rows: list[tuple[str, str]]) -> list[str | None]:
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str, str]:
    """All scripts in order of cost and letters until one ends well."""
    faults = faults_of(rows)
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, script, i, last, made = heapq.heappop(heap)
        if (i, last) in done and i < len(rows):
            pass
        if i == len(rows) and last in ("", "a"):
            return cost, script, hashlib.sha256("\n".join(made).encode()).hexdigest()
        if (i, last, script) in done:
            continue
        done.add((i, last, script))
        for role, name in (("u", "user"), ("a", "assistant")):
            if role in legal[last] and script[-3:] != "III":
                heapq.heappush(heap, (cost + 2, script + "I", i, role, (*made, name + ":")))
        if i == len(rows):
            continue
        (role, text), fault = rows[i], faults[i]
        heapq.heappush(heap, (cost + 3, script + "D", i + 1, last, made))
        if fault in ("blank", "duplicate"):
            continue
        more = 1 if fault == "truncated" else 0
        if role[:1] and role[:1] in legal[last]:
            heapq.heappush(heap, (cost + more, script + "K", i + 1, role[:1], (*made, f"{role}:{text}")))
        for own, name in (("u", "user"), ("a", "assistant")):
            if own in legal[last]:
                heapq.heappush(heap, (cost + 2 + more, script + "R", i + 1, own, (*made, f"{name}:{text}")))
    raise AssertionError


def searched(rows: list[tuple[str, str]]) -> tuple[tuple[int, str, str], int]:
    search = turns.Search()
    for (role, text), fault in zip(rows, faults_of(rows), strict=True):
        search.row(role, text, fault)
    return search.end(), search.most_open


def test_every_short_conversation():
    for n in range(6):
        for roles in product("sua", repeat=n):
            rows = [({"s": "system", "u": "user", "a": "assistant"}[r], f"{i}.") for i, r in enumerate(roles)]
            assert searched(rows)[0] == cheapest(rows), roles


def test_random_conversations():
    draw = random.Random(3)
    for _ in range(400):
        rows = [(draw.choice(["system", "user", "assistant", "tool", "", "umpire"]), draw.choice(["", " \n", "a.", "b", "c!", "d? "])) for _ in range(draw.randrange(7))]
        assert searched(rows)[0] == cheapest(rows), rows


def test_open_part_stays_small_unless_ties_go_on():
    roles = ["system", *(["user", "assistant"] * 2000)]
    (cost, script, _), most = searched([(r, f"{i}.") for i, r in enumerate(roles)])
    assert (cost, script) == (0, "K" * 4001) and most < 12
    draw = random.Random(1)
    noisy = [(draw.choice(["user", "assistant"]), f"{i}" + draw.choice([".", "", "!"])) for i in range(3000)]
    assert searched(noisy)[1] < 100
    # Every second row reroled, or one turn inserted: which is cheaper is open to the end.
    (cost, script, _), most = searched([("user", f"{i}.") for i in range(3001)])
    assert cost == 3002 and script == "KI" + "KR" * 1500 and most > 3000


CONVERSATIONS = "conv_id long, turn long, role string, text string, fault string, kind int"


def conversation_rows() -> list[tuple]:
    draw = random.Random(8)
    out = []
    for conv in (None, *range(40)):
        for turn in range(draw.randrange(9)):
            turn = draw.choice([turn, turn, turn, None, turn + 3])
            out.append((conv, turn, draw.choice(["system", "user", "assistant", "user", "assistant", None]), draw.choice([f"say {turn}.", "tell", "", None, "ask?"]), "x", 1))
    out.append((90, 1, "user", "the same. " * 20_000, None, None))
    out += [(91, None, "user", "a.", None, None)] * 3
    return out


def test_audit_and_repaired_rows(spark):
    rows = conversation_rows()
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    got = {r.conv_id: r for r in turns.audit(frame).collect()}
    made: dict = {}
    for r in turns.repaired(frame, turns.audit(frame)).collect():
        made.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    space = lambda x: " " if x is None else x
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    convs = {r[0] for r in rows}
    assert set(got) == convs
    for conv in convs:
        own = sorted(((t, space(role), space(text)) for c, t, role, text, *_ in rows if c == conv), key=key)
        pairs = [(role, text) for _, role, text in own]
        known = [t for t, _, _ in own if t is not None]
        faults = Counter(faults_of(pairs))
        r = got[conv]
        assert (r.cost, r.audit, r.repaired_sha256) == cheapest(pairs)
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults[f] for f in turns.FAULTS)
        assert r.gaps == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
        letters = [role[:1] for role, _ in pairs]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        repaired = sorted(made.get(conv, []))
        assert [p for p, _ in repaired] == list(range(len(repaired)))
        assert hashlib.sha256("\n".join(t for _, t in repaired).encode()).hexdigest() == r.repaired_sha256


def test_damage_and_conversations_without_rows(spark):
    rows = [(c, t, "user", "Go. Stop!", "x", 1) for c in range(60) for t in range(2)] + [(None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, CONVERSATIONS)
    damaged = Counter((r.conv_id, r.turn, r.role, r.text) for r in turns.damaged(frame).collect())
    want: Counter = Counter()
    for c, t, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "Go Stop"}.get(kind, text or " ")
        if kind:
            want[c, t, "user" if kind == 4 else role or " ", text] += 2 if kind == 3 else 1
    assert damaged == want
    lost = frame.where("conv_id = 7")
    report = {r.conv_id: r for r in turns.audit_all(frame, turns.damaged(frame).where("conv_id is null or conv_id <> 7")).collect()}
    assert set(report) == {r[0] for r in rows} and lost.count() == 2
    assert tuple(report[7])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    none = spark.createDataFrame([], CONVERSATIONS)
    assert turns.audit_all(none, turns.damaged(none)).count() == 0 and turns.repaired(none, turns.audit(none)).count() == 0


# ---- operator 13


def plain_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """Every stretch of every lag, and of equal stretches the smallest lag."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def periodic_texts() -> list[str | None]:
    draw = random.Random(5)
    texts: list[str | None] = [None, "", " \n\t", "one", "a a a a a", "a a a a a a", "a b a b a b a b", "x y z", "a a a a a a b b b b b b"]
    for _ in range(150):
        words: list[str] = []
        while len(words) < draw.choice([10, 60, 300]):
            block = [draw.choice("abc") for _ in range(draw.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 13, 20, 31]))]
            words += block * draw.choice([1, 1, 3, 4, 5, 9]) + block[: draw.randrange(len(block))]
        texts.append(draw.choice([" ", "\n", " \t "]).join(words))
    texts.append("spam ham " * 30_000)
    return [*texts, texts[-2], texts[-2]]


@pytest.fixture(scope="module")
def periodic():
    return periodic_texts()


def test_runs_equal_brute_force(periodic):
    short = [(t or "").encode() for t in periodic if len(t or "") < 5000]
    numbered = cycles.number_words(short)
    got = cycles.find_runs(numbered.words, numbered.bounds)
    for text, runs in zip(short, got, strict=True):
        assert runs == plain_runs([w.decode() for w in text.split()]), text


def test_scales_guarantee_a_seed():
    before = 0
    for low, high, k in cycles.scales(1 << 20):
        assert low == before + 1 <= high and 2 * high <= k
        assert all(max(cycles.LEAST, cycles.TIMES * q) - q >= k for q in range(low, high + 1))
        before = high


def test_numbers_of_parts(monkeypatch, periodic):
    texts = [(t or "").encode() for t in periodic[:40]] + [b" lead", b"x" * 90]
    whole = cycles.number_words(texts)
    monkeypatch.setattr(cycles, "_PART", 16)
    parts = cycles.number_words(texts)
    assert parts.bounds == whole.bounds and parts.words.tolist() == whole.words.tolist() and parts.table == whole.table


def test_documents_with_runs(spark, periodic):
    rows = [(i, t, "en", "x", 1) for i, t in enumerate(periodic)] + [(None, "b " * 9, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    found = cycles.repeated_runs(frame, plant=cycles.crc_of(F.col("doc_id")), with_text=True)
    got = {r.doc_id: r for r in cycles.digest(found).collect()}
    texts = {r.doc_id: r.collapsed for r in found.collect()}
    assert len(got) == len(rows)
    checked = 0
    for doc_id, text, *_ in rows:
        words = (text or "").replace("\n", " ").replace("\t", " ").split(" ")
        words = [w for w in words if w]
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n = len(words)
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
        runs = plain_runs(words) if n < 5000 else [(0, n, 2)]
        checked += h % 10 == 0 and n > 0
        r = got[doc_id]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest() and texts[doc_id] == kept
    assert checked > 5
    assert cycles.digest(cycles.repeated_runs(frame.limit(0))).count() == 0
