"""URL filter: rules first, then naive Bayes over segmented host and path tokens.

Host names run words together. A unigram model of the words in the pages' paths and visible
text splits them: Viterbi chooses the split of highest probability, where an unknown piece costs more
with each letter. The pieces and the path's words feed a multinomial naive Bayes classifier,
which learns from the pages that a rule decides and judges the others.

Counts cover all pages. Word counts meet the hosts' substrings, and token weights the pages'
tokens, in joins, so no vocabulary is broadcast or collected; hosts are split once each,
however many pages they have.

Input: ``page_id``, ``url``, ``html``. A null url or one without ``://`` has empty host and path and no
tokens; repeated rows give repeated results; an empty table gives no rows; other columns are
ignored. Where the rules decide no page, or all alike, the method allows; so it does where both classes score the same. Of rules of
one length that fit, the last in ``RULES`` counts; of splits of one probability, the one with the longest last piece."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: (host, path, verdict); a rule fits its host and all subdomains and paths that start with its own.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def visible(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")


def _split(label: str, known: dict[str, int], total: int) -> list[str]:
    """The cheapest pieces of a label; of equal ones the longest last piece."""
    size = len(label)
    # an unknown piece: as if seen once, ten times rarer with each letter
    unknown = math.log(total + 1) + np.arange(size + 1) * math.log(10)
    ending: dict[int, list[tuple[int, float]]] = {}
    for piece, n in known.items():
        begin = label.find(piece)
        while begin >= 0:
            ending.setdefault(begin + len(piece), []).append((begin, math.log(total + 1) - math.log(n)))
            begin = label.find(piece, begin + 1)
    best, froms = np.zeros(size + 1), [0] * (size + 1)
    for end in range(1, size + 1):
        costs = best[:end] + unknown[end:0:-1]
        for begin, cost in ending.get(end, ()):
            costs[begin] = best[begin] + cost
        froms[end] = int(costs.argmin())
        best[end] = costs[froms[end]]
    parts, end = [], size
    while end:
        parts.append(label[froms[end] : end])
        end = froms[end]
    return parts[::-1]


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)))
        out = [_split(label, {w["piece"]: w["n"] for w in known or () if w["n"]}, total) for label, known, total in rows]
        yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["label", "pieces"])


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, pieces) of each distinct label by unigram Viterbi; ``counts`` has (piece, n).

    Of a label only the substrings as long as some counted word are looked up. They are rows of their own from the start, so a
    label of any length is no large row until its known words are brought together."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lengths = sorted(r[0] for r in counts.select(F.length("piece")).distinct().collect())  # at most as many as the longest word has letters
    distinct = labels.where("label <> ''").distinct()
    size = F.length("label")
    begun = distinct.select("label", F.md5("label").alias("id"), F.explode(F.filter(F.lit(lengths or [0]).cast("array<int>"), lambda n: (n > 0) & (n <= size))).alias("length"))
    begun = begun.select("label", "id", "length", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)).alias("begin"))
    pieces = begun.select("id", F.substring("label", F.col("begin"), F.col("length")).alias("piece"))
    known = pieces.join(counts, "piece").groupBy("id").agg(F.collect_set(F.struct("piece", "n")).alias("known"))  # the words in one label
    joined = distinct.withColumn("id", F.md5("label")).join(known, "id", "left")
    return joined.select("label", "known", F.lit(total).cast("long").alias("total")).mapInArrow(_splits, "label string, pieces array<string>")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of block; null where a rule decides)."""
    host, path = split_url(pages["url"].cast("string"))
    base = pages.select(pages["page_id"].cast("long").alias("page_id"), host.alias("host"), path.alias("path"), pages["html"].cast("string").alias("html"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": name, "ruled": verdict})
    text = F.concat(words_of(F.col("path")), words_of(visible(F.col("html"))))
    counts = written(base.select(F.explode(text).alias("piece")).groupBy("piece").agg(F.count("*").alias("n")))

    # pages alike in host, path and rule are one row from here on, with their number
    urls = written(base.groupBy("host", "path", "rule", "ruled").agg(F.count("*").alias("n")))
    labels = F.filter(F.split("host", r"[^\p{L}\p{N}]+"), lambda x: x != "")
    split = segment(urls.select(F.explode(labels).alias("label")), counts)
    of_host = urls.select("host", F.posexplode(labels).alias("pos", "label")).distinct().join(split, "label")
    of_host = of_host.select("host", F.explode("pieces").alias("token")).groupBy("host", "token").agg(F.count("*").alias("k"))
    path_words = urls.select("path").distinct().select("path", F.explode(words_of(F.col("path"))).alias("token")).groupBy("path", "token").agg(F.count("*").alias("k"))
    tokens = urls.select("host", "path", "ruled", "n").join(of_host.select("host", F.concat(F.lit("h:"), "token").alias("token"), "k"), "host").select("host", "path", "ruled", "n", "token", "k")
    tokens = written(tokens.unionByName(urls.select("host", "path", "ruled", "n").join(path_words.select("path", F.concat(F.lit("p:"), "token").alias("token"), "k"), "path").select("host", "path", "ruled", "n", "token", "k")))

    classes = {r.ruled: r.n for r in urls.where("ruled is not null").groupBy("ruled").agg(F.sum("n").alias("n")).collect()}  # two rows
    by_token = tokens.where("ruled is not null").groupBy("token").agg(*(F.coalesce(F.sum(F.when(F.col("ruled") == c, F.col("n") * F.col("k"))), F.lit(0)).alias(c) for c in ("allow", "block")))
    by_token = written(by_token)
    sums = by_token.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0)), F.count("*")).first()
    weight = F.log((F.col("block") + 1.0) / F.lit(float(sums[1] + sums[2] + 1))) - F.log((F.col("allow") + 1.0) / F.lit(float(sums[0] + sums[2] + 1)))
    prior = math.log(classes["block"] / classes["allow"]) if len(classes) == 2 else -math.inf
    scored = tokens.where("ruled is null").join(by_token.select("token", weight.alias("w")), "token").groupBy("host", "path").agg(F.sum(F.col("w") * F.col("k")).alias("odds"))
    # whole sums to nine places, so that the order of addition doesn't show
    judged = base.select("page_id", "host", "path", "rule", "ruled").join(scored, ["host", "path"], "left")
    score = F.when(F.col("ruled").isNull(), F.round(F.coalesce("odds", F.lit(0.0)) + F.lit(prior), 9))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(score > 0, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
