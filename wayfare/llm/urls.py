"""URL filter: block and allow rules, and boosted trees for the urls no rule fits.

Features are lexical and computed by columns: lengths, depth, digit ratio,
character entropy, parameter counts and statistics of the host's suffixes
(last one, two and three labels: how often labelled urls with that suffix are
blocked).  The labelled urls are those that a rule decides.  The statistics
are a table of all their suffixes, joined to the urls (broadcast while it is
small).  The trees are fitted on a bounded sample of the different labelled
urls (``max_rows``, smallest hashes first, weighted by their number of rows)
and compiled into one ``CASE WHEN`` sum, so that judging is a scan, the join
and a projection in generated code.

Edge cases: a null url or one without ``://`` has empty host and path, no rule
fits it and the trees judge it; of rules of one length the first by name wins;
very long urls are read whole; repeated rows are judged one by one and weigh by
their number; an empty table gives an empty result; without labelled urls, or
with labels of one kind only, the trees are a constant; extra columns pass
through, also those with the names of our own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, Scratch, free_name

#: (verdict, host, path prefix): the rules of the default filter.
DEFAULT_RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
NUMERIC = ("url_chars", "host_chars", "path_chars", "labels", "hyphens", "depth", "digit_ratio", "entropy", "parameters", "query_chars")
SUFFIXES = ("suffix1", "suffix2", "suffix3")
#: Suffixes (of one level) up to which their rates are broadcast, and the most characters that these may have in all.
BROADCAST_SUFFIXES, BROADCAST_CHARS = 100_000, 8 << 20


def parse(urls: DataFrame, column: str = "url") -> DataFrame:
    """``urls`` with host (A-Z lower-cased) and path."""
    at = F.locate("://", F.col(column))
    rest = F.when(at > 0, F.substr(F.col(column), at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    return urls.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def apply_rules(parsed: DataFrame, rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES) -> DataFrame:
    """``rule`` (host and path prefix) and ``rule_verdict`` of the longest rule that fits, else null."""
    by_length = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in reversed(by_length):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return parsed.withColumn("rule", name).withColumn("rule_verdict", verdict)


def with_features(parsed: DataFrame, column: str = "url") -> DataFrame:
    url = F.coalesce(F.col(column), F.lit(""))
    n = F.length(url)
    letters = F.array_distinct(F.split(url, "", -1))
    share = lambda c: F.when(c != "", (n - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(F.filter(F.transform(letters, share), lambda p: p > 0), F.lit(0.0), lambda s, p: s - p * F.log2(p))
    count = lambda text, c: n_of(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    n_of = F.length
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = {
        "url_chars": n,
        "host_chars": F.length("host"),
        "path_chars": F.length("path"),
        "labels": count(F.col("host"), "."),
        "hyphens": count(F.col("host"), "-"),
        "depth": count(F.col("path"), "/"),
        "digit_ratio": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "query_chars": F.length(query),
    }
    for i, name in enumerate(SUFFIXES, 1):
        values[name] = F.substring_index("host", ".", -i)
    return parsed.withColumns({k: v if k in SUFFIXES else v.cast("double") for k, v in values.items()})


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(level, suffix, blocked, n) of all suffixes of the labelled urls."""
    suffixes = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.col(k).alias("suffix")) for k in SUFFIXES]))
    ones = labelled.where(F.col("rule_verdict").isNotNull()).select((F.col("rule_verdict") == "block").cast("long").alias("y"), suffixes.alias("s"))
    return ones.groupBy("s.level", "s.suffix").agg(F.sum("y").alias("blocked"), F.count(F.lit(1)).alias("n"))


def with_rates(featured: DataFrame, counts: DataFrame, base_rate: float, small: dict[str, bool]) -> DataFrame:
    """Suffix statistics as columns; a suffix that no labelled url has gets the overall rate."""
    for name in SUFFIXES:
        rate = (F.col("blocked") + F.lit(20 * base_rate)) / (F.col("n") + F.lit(20))
        table = counts.where(F.col("level") == name).select(F.col("suffix").alias(f"__{name}"), rate.alias(f"{name}_rate"))
        joined = featured.join(F.broadcast(table) if small.get(name, True) else table, F.col(name) == F.col(f"__{name}"), "left").drop(f"__{name}")
        featured = joined.withColumn(f"{name}_rate", F.coalesce(f"{name}_rate", F.lit(base_rate)))
    return featured


@dataclass
class Model:
    prior: float = 0.0
    trees: list = field(default_factory=list)

    def margin(self) -> Column:
        total = F.lit(self.prior)
        for tree in self.trees:
            total = total + _compiled(tree)
        return total


def _compiled(node) -> Column:
    if not isinstance(node, tuple):
        return F.lit(float(node))
    name, cut, low, high = node
    return F.when(F.col(name) <= F.lit(float(cut)), _compiled(low)).otherwise(_compiled(high))


def _grow(x: np.ndarray, names: Sequence[str], cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rate: float, least: int = 20, ridge: float = 1.0):
    """A regression tree for gradients g and curvatures h; leaves hold shrunken Newton steps."""
    leaf = -rate * g.sum() / (h.sum() + ridge)
    if not depth or len(g) < 2 * least:
        return leaf
    best, whole = (1e-6, None, None), g.sum() ** 2 / (h.sum() + ridge)
    for j, points in enumerate(cuts):
        for c in points:
            low = x[:, j] <= c
            k = int(low.sum())
            if least <= k <= len(g) - least:
                a, b = g[low].sum(), h[low].sum()
                gain = a * a / (b + ridge) + (g.sum() - a) ** 2 / (h.sum() - b + ridge) - whole
                if gain > best[0]:
                    best = (gain, j, c)
    if best[1] is None:
        return leaf
    _, j, c = best
    low = x[:, j] <= c
    return (names[j], float(c), _grow(x[low], names, cuts, g[low], h[low], depth - 1, rate, least, ridge), _grow(x[~low], names, cuts, g[~low], h[~low], depth - 1, rate, least, ridge))


def _predict(node, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    if not isinstance(node, tuple):
        return np.full(len(x), node)
    low = x[:, list(names).index(node[0])] <= node[1]
    return np.where(low, _predict(node[2], x, names), _predict(node[3], x, names))


def sample(labelled: DataFrame, distinct_urls: int, max_rows: int) -> DataFrame:
    """At most ``max_rows`` different labelled urls, those with the smallest hashes, each with the number of its rows as ``times``.

    The hash threshold comes from the (estimated) number of different urls, so
    that only about the rows that are wanted are grouped and sorted.
    """
    part = F.pmod(F.xxhash64("url"), F.lit(1 << 30))
    below = 1 << 30 if distinct_urls <= 2 * max_rows else math.ceil((1 << 30) * 1.5 * max_rows / distinct_urls)
    few = labelled.where(F.col("rule_verdict").isNotNull()).withColumn("__part", part).where(F.col("__part") < below)
    times = few.groupBy("__part", "url").agg(F.count(F.lit(1)).alias("times"), F.min("rule_verdict").alias("rule_verdict"))
    return times.orderBy("__part", "url").limit(max_rows)


def fit(chosen: DataFrame, trees: int = 20, depth: int = 3, rate: float = 0.3) -> Model:
    """Boosted trees for ``rule_verdict`` = block on chosen urls with features, rates and ``times`` (their weight)."""
    names = [*NUMERIC, *(f"{k}_rate" for k in SUFFIXES)]
    rows = chosen.orderBy(F.xxhash64("url"), "url").select(*names, "times", (F.col("rule_verdict") == "block").cast("int").alias("y")).collect()
    y = np.array([r["y"] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(prior=0.0 if not len(y) else (4.0 if y[0] else -4.0))
    weight = np.array([r["times"] for r in rows], dtype=float)
    weight /= weight.mean()
    share = float((y * weight).sum() / weight.sum())
    model = Model(prior=float(np.log(share / (1 - share))))
    x, margin = np.array([[r[k] for k in names] for r in rows], dtype=float), np.full(len(y), model.prior)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1])) for j in range(x.shape[1])]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, names, cuts, weight * (p - y), weight * p * (1 - p), depth, rate)
        model.trees.append(tree)
        margin = margin + _predict(tree, x, names)
    return model


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES, column: str = "url", max_rows: int = 8192, **params) -> DataFrame:
    """``pages`` with host, path, rule, ``block_margin`` of the trees and verdict (the rule's, else the trees').

    Rows of ``pages`` travel as one struct, so columns of any name come back
    untouched; where one has the name of ours, ours gets underscores behind it.
    """
    work = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("__row"), F.col(column).cast("string").alias("url"))
    ruled = apply_rules(parse(work), rules)
    featured = with_features(ruled)
    counts = Scratch(pages.sparkSession, "urls").put(suffix_counts(featured), "suffixes")
    sizes = {
        r["level"]: r
        for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("k"), F.sum(F.length("suffix")).alias("chars"), F.sum("blocked").alias("blocked"), F.sum("n").alias("n")).collect()
    }
    one = sizes.get(SUFFIXES[0])
    base = one["blocked"] / one["n"] if one else 0.5
    small = {k: r["k"] <= BROADCAST_SUFFIXES and r["chars"] <= BROADCAST_CHARS for k, r in sizes.items()}
    labelled = ruled.select("url", "rule_verdict")
    different = labelled.where(F.col("rule_verdict").isNotNull()).agg(F.approx_count_distinct("url")).first()[0] if one else 0
    chosen = with_features(parse(sample(labelled, different, max_rows)))
    model = fit(with_rates(chosen, counts, base, small), **params)
    scored = with_rates(featured, counts, base, small).withColumn("block_margin", model.margin())
    verdict = F.coalesce("rule_verdict", F.when(F.col("block_margin") > 0, "block").otherwise("allow"))
    scored = scored.withColumn("verdict", verdict)
    return scored.select("__row.*", *[F.col(c).alias(free_name(pages, c)) for c in ("host", "path", "rule", "block_margin", "verdict")])
