"""URL filters: host rules first, then logistic regression on hashed character n-grams of host and path.

Rules are matched by built-in functions. The model is trained on the driver from a small labelled table (at most
``MOST_SEEDS`` rows) and scores batches of URLs in numpy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import lower_ascii
from paperloom.llm.url_seed import seed_urls

#: (rule, verdict): host, then the start of the path. A rule fits its host and all subdomains; the longest one wins.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The columns that ``judge_urls`` adds.
NEW = ("host", "path", "rule", "verdict", "p_block")
DIMENSIONS, GRAMS = 1 << 16, (3, 4, 5)
MOST_SEEDS, ROUNDS, L2 = 100_000, 100, 1e-6
#: The smallest tenth at which a model trained without a fifth of the words blocks at most one in fifty allowed URLs of
#: these words; measured on another fifth.
THRESHOLD = 0.6


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, of equally long ones the one given last, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):  # later, longer rules go before
        name, start = text.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def _features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams as (row, column, value): each row's values have the length 1. Digits count as one sign."""
    data = [b"^" + h.encode() + b"$" + p.encode() + b"$" for h, p in zip(hosts, paths, strict=True)]
    ends = np.cumsum([len(x) for x in data])
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    raw[(raw >= 48) & (raw <= 57)] = 48
    row = np.repeat(np.arange(len(data)), np.diff(ends, prepend=0))
    rows, columns = [], []
    for n in GRAMS:
        if raw.size < n:
            continue
        h = np.zeros(raw.size - n + 1, np.uint64)
        for k in range(n):
            h = (h * np.uint64(1_099_511_628_211)) ^ raw[k : raw.size - n + 1 + k]
        h = (h ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        inside = row[: h.size] == row[n - 1 :]
        rows.append(row[: h.size][inside])
        columns.append((h[inside] >> np.uint64(48)).astype(np.int64) % DIMENSIONS)
    r, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, columns))
    return r, c, 1 / np.sqrt(np.maximum(1, np.bincount(r, minlength=len(data))))[r]


def train(table: list[tuple[str, int]] | None = None) -> np.ndarray:
    """Weights and, last, the intercept: full-batch gradient steps with momentum on the labelled table (label 1: blocked).
    A weight's step is as long as its n-gram's share of the table allows, so rare ones learn as fast as common ones."""
    table = (table or seed_urls())[:MOST_SEEDS]
    split = [_plain(u) for u, _ in table]
    y = np.array([label for _, label in table], float)
    r, c, v = _features([h for h, _ in split], [p for _, p in split])
    curvature = np.bincount(c, v * v, DIMENSIONS) / (4 * len(y)) * np.bincount(r, minlength=len(y)).max()
    step = 1 / (curvature + L2)
    w, b, speed, push = np.zeros(DIMENSIONS), 0.0, np.zeros(DIMENSIONS), 0.0
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-(np.bincount(r, v * w[c], len(y)) + b))) - y
        speed = 0.9 * speed - step * (np.bincount(c, v * error[r], DIMENSIONS) / len(y) + L2 * w)
        push = 0.9 * push - error.mean()
        w, b = w + speed, b + push
    return np.append(w, b)


def _plain(url: str) -> tuple[str, str]:
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    return rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]


def probabilities(hosts: list[str], paths: list[str], weights: np.ndarray) -> np.ndarray:
    r, c, v = _features(hosts, paths)
    return 1 / (1 + np.exp(-(np.bincount(r, v * weights[c], len(hosts)) + weights[-1])))


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, table=None, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with host, path, rule, verdict and p_block.

    verdict is the longest fitting rule's, else ``block`` where the model's probability reaches the threshold. p_block
    is computed for every URL. Null URLs and those without ``://`` have empty host and path and are judged by the model
    as such. URLs may have any length. Repeated rows are judged alike; columns of the input that clash with the new ones
    are replaced; an empty table gives an empty result.
    """
    weights = train(table)  # DIMENSIONS + 1 numbers

    @F.pandas_udf("double")
    def score(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series(probabilities(host.tolist(), path.tolist(), weights))

    names = pages.columns
    plain = pages.toDF(*(f"c{k}" for k in range(len(names))))  # so that no name of the input meets one of ours
    host, path = host_and_path(F.col(f"c{names.index(url_col)}").cast("string"))
    known = plain.withColumns({"host": host, "path": path}).withColumn("p_block", score("host", "path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    kept = [F.col(f"c{k}").alias(c) for k, c in enumerate(names) if c not in NEW]
    return known.select(*kept, "p_block", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
