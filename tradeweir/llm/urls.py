"""URL filter: rules first, then words of the host and path (operator 8).

Host names are concatenated words. A unigram model, counted over the words of all documents, splits each
label of a host (Viterbi). Multinomial naive Bayes then scores the host's words and the path's tokens.
Its training classes come from seed words: urls whose host holds a seed word are examples to block, all others to
allow; it generalises from them to words that occur beside them.

Only the substrings of host labels are joined to the word counts, so that neither the vocabulary nor the
hosts are held in one place. Defined results: a null url, or one without ``://``, has an empty host and path, no
tokens and no rule, and is judged by the classes' sizes; equal urls have equal verdicts; a null page id is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import passes, stored
from tradeweir.llm.words import hash_runs, words_of

MAX_WORD = 20
# Words that name kinds of host which corpora leave out.
SEEDS = (
    "ads adserver adult bet bets bingo casino escort gambling jackpot loan loans malware payday phishing pills "
    "poker porn pharma sex slots spam track tracker viagra warez xxx"
).split()
# Fixed values: (host, path, verdict) of the rule list.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        name = F.when(fits, F.lit(own_host + own_path)).otherwise(name)
        verdict = F.when(fits, F.lit(own_verdict)).otherwise(verdict)
    return name, verdict


def word_counts(texts: DataFrame) -> DataFrame:
    """Hash and number of every word of a table with one column ``text``, added up per pass before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, limit=8 << 20):
            found, n = np.unique(words_of(batch.column(0)).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])

    return texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Words of each different name in the column ``label``: columns ``label`` and ``words``."""
    total = counts.agg(F.sum("n")).first()[0] or 1

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label in batch.column(0).to_pylist():
                data = np.frombuffer(label.encode(), np.uint8)
                edges = [i for i in range(len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
                pairs = [(i, j) for k, i in enumerate(edges) for j in edges[k + 1 : k + 1 + MAX_WORD]]
                start, end = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label] * len(pairs)),
                        pa.array(start.astype(np.int32)),
                        pa.array(end.astype(np.int32)),
                        pa.array(hash_runs(data, start, end).view(np.int64)),
                    ],
                    ["label", "start", "end", "word"],
                )

    def viterbi(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            split = [best_split(label, spans) for label, spans in zip(frame["label"], frame["spans"], strict=True)]
            yield pd.DataFrame({"label": frame["label"], "words": split})

    def best_split(label: str, spans) -> list[str]:
        data = label.encode()
        known = {(s["start"], s["end"]): s["n"] for s in spans if s["n"] is not None}
        edges = [i for i in range(len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
        best: dict[int, tuple[float, int]] = {0: (0.0, 0)}
        for k, end in enumerate(edges[1:], 1):
            options = []
            for at in range(max(0, k - MAX_WORD), k):
                start = edges[at]
                n = known.get((start, end))
                # An unknown name is the less likely, the longer it is.
                cost = math.log(n / total) if n else math.log(1 / total) - 2.3 * (k - at)
                options.append((best[start][0] + cost, start))
            best[end] = max(options)
        words, end = [], len(data)
        while end:
            start = best[end][1]
            words.append(data[start:end].decode())
            end = start
        return words[::-1]

    names = labels.where("label <> ''").select("label").distinct()
    spans = names.mapInArrow(substrings, "label string, start int, end int, word long").join(counts, "word", "left")
    grouped = spans.groupBy("label").agg(F.collect_list(F.struct("start", "end", "n")).alias("spans"))
    return grouped.mapInPandas(viterbi, "label string, words array<string>")


def judge(pages: DataFrame, texts: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """Verdict on every row of ``pages`` (page_id, url); ``texts`` (text) gives the word counts."""
    host, path = split_url(F.col("url").cast("string"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    urls = stored(urls, "urls")
    counts = stored(word_counts(texts), "counts")

    hosts = urls.groupBy("host").agg(F.count("*").alias("n")).where("host <> ''")
    labels = hosts.select("host", "n", F.posexplode(F.split("host", r"[.\-_:@]+")).alias("place", "label"))
    words = labels.join(segment(labels, counts), "label").select("host", "n", F.explode("words").alias("word"))
    words = stored(words.select("host", "n", "word"), "host-words")
    marked = words.groupBy("host").agg(F.max(F.col("word").isin(list(seeds)).cast("int")).alias("bad"))
    host_tokens = words.join(marked, "host").select(F.concat(F.lit("h:"), "word").alias("token"), "host", "n", "bad")

    urls_marked = urls.join(marked, "host", "left").withColumn("bad", F.coalesce("bad", F.lit(0)))
    parts = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    token = F.when(F.col("part").rlike(r"^\p{N}+$"), F.lit("p:#")).otherwise(F.concat(F.lit("p:"), F.col("part")))
    path_tokens = urls_marked.select("row", "bad", F.explode(parts).alias("part")).select("row", "bad", token.alias("token"))

    tokens = host_tokens.groupBy("token").agg(F.sum(F.col("n") * F.col("bad")).alias("b"), F.sum(F.col("n") * (1 - F.col("bad"))).alias("a"))
    more = path_tokens.groupBy("token").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("a"))
    tokens = stored(tokens.union(more).groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "tokens")
    sums = tokens.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    bad, good, kinds = (x or 0 for x in sums)
    n = urls_marked.agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
    prior = math.log(((n[0] or 0) + 1) / ((n[1] or 0) + 1))
    weight = F.log((F.col("b") + 1.0) / (bad + kinds + 1)) - F.log((F.col("a") + 1.0) / (good + kinds + 1))
    weights = tokens.select("token", weight.alias("w"))

    host_score = host_tokens.select("host", "token").join(weights, "token").groupBy("host").agg(F.sum("w").alias("host_w"))
    path_score = path_tokens.select("row", "token").join(weights, "token").groupBy("row").agg(F.sum("w").alias("path_w"))
    log_odds = F.lit(prior) + F.coalesce("host_w", F.lit(0.0)) + F.coalesce("path_w", F.lit(0.0))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = urls.join(host_score, "host", "left").join(path_score, "row", "left")
    split = words.groupBy("host").agg(F.sort_array(F.collect_set("word")).alias("host_words"))
    return out.join(split, "host", "left").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, F.when(log_odds > 0, "block").otherwise("allow")).alias("verdict"),
        log_odds.alias("log_odds"),
        "host_words",
    )
