"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of whole texts are computed in one pass. On a bounded sample of labelled rows the driver boosts small trees, takes every path
from a root as a conjunctive rule, and fits logistic weights with a lasso penalty; rules that keep a weight become one Spark column
expression, which scores all rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, quoted, ship_code, utf8_values

#: Labelled rows that the classifier is fitted on, chosen by a hash of their id; the bound of what the driver collects.
SAMPLE = 20_000
#: Trees, their depth, rows of the smallest leaf, candidate cuts of a statistic, step of boosting.
TREES, DEPTH, LEAF, CUTS, STEP = 40, 3, 15, 32, 0.3
#: Lasso penalty, as a share of the smallest that leaves no rule; rounds of the fit.
PENALTY, ROUNDS = 0.01, 400
#: A text is kept if its score is at least this.
THRESHOLD = 0.3

STATISTICS = (
    "bytes", "words", "word_length", "distinct_words", "top_word", "repeated_pairs", "upper", "digits", "stops", "symbols", "bangs", "bars", "wide", "marked_words",
    "upper_words", "lines", "line_length", "repeated_lines", "packed",
)

_upper, _digits, _stops, _bangs, _bars = (np.frombuffer(x, np.uint8) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?", b"!", b"|"))
_symbols = np.frombuffer(b"#$%&*@^~<>=+\\/_{}[]`", np.uint8)


def statistics(value: bytes) -> tuple[float, ...]:
    """The statistics of one text, in the order of STATISTICS; shares are of bytes, words or lines, 0 for an empty text."""
    n = max(1, len(value))
    of = np.bincount(np.frombuffer(value, np.uint8), minlength=256)
    words = value.split()
    w = max(1, len(words))
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in value.split(b"\n") if x]
    k = max(1, len(lines))
    marked = sum(c for x, c in seen.items() if not (97 <= (x[-1] | 32) <= 122 or x[-1] >= 128 or x[-1] in b".,"))
    upper = sum(c for x, c in seen.items() if x.isupper() and len(x) > 1)
    return (
        float(len(value)), float(len(words)), (len(value) - of[32]) / w, len(seen) / w, max(seen.values(), default=0) / w, 1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        of[_upper].sum() / n, of[_digits].sum() / n, of[_stops].sum() / n, of[_symbols].sum() / n, of[_bangs].sum() / n, of[_bars].sum() / n, of[128:].sum() / n, marked / w,
        upper / w, float(len(lines)), w / k, 1 - len(set(lines)) / k if lines else 0.0, len(zlib.compress(value, 1)) / n,
    )


def with_statistics(df: DataFrame, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns of `keep` as k0, k1 and so on, whatever their names, and the statistics of every row's text as _s_...; null counts as
    empty. A kept text crosses to Python once."""
    ship_code(df.sparkSession)
    names = [f"k{i}" for i in range(len(keep))]
    text = names[list(keep).index(text_col)] if text_col in keep else "t"
    chosen = df.select(*(c.alias(n) for n, c in zip(names, keep.values(), strict=True)), *([] if text in names else [df[quoted(text_col)].alias("t")]))
    found_names = [f"_s_{s}" for s in STATISTICS]

    def scan(batches):
        for batch in chunks(batches, text):
            found = np.array([statistics(v) for v in utf8_values(batch.column(text))], np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pa.array(found[:, i]) for i in range(len(STATISTICS)))], [*names, *found_names])

    kept = [f"{n} {chosen.schema[n].dataType.simpleString()}" for n in names]
    return chosen.mapInArrow(scan, ", ".join([*kept, *(f"{s} double" for s in found_names)]))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, True for <= or False for >, cut)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(x[:, i] <= cut) if below else (x[:, i] > cut) for i, below, cut in self.terms])

    def column(self) -> Column:
        parts = [(F.col(f"_s_{STATISTICS[i]}") <= cut) if below else (F.col(f"_s_{STATISTICS[i]}") > cut) for i, below, cut in self.terms]
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1 as a column expression over the statistics."""
        total = reduce(lambda a, b: a + b, [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.bias))
        return 1 / (1 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + sum((w * r.holds(x) for r, w in self.rules), np.zeros(len(x))))))


def grow(x: np.ndarray, cuts: list[np.ndarray], codes: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """One regression tree by second-order gain: the rules of all its nodes but the root, and each row's leaf value."""
    rules, value = [], np.zeros(len(x))

    def split(rows: np.ndarray, terms: tuple, depth: int) -> None:
        g, h = gradient[rows].sum(), weight[rows].sum()
        best = (1e-6, -1, -1)
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            for i, at in enumerate(cuts):
                if not len(at):
                    continue
                c = codes[rows, i]
                gl, hl, nl = (np.cumsum(np.bincount(c, v, len(at) + 1))[:-1] for v in (gradient[rows], weight[rows], np.ones(len(rows))))
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                gain[(nl < LEAF) | (len(rows) - nl < LEAF)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), i, k)
        if best[1] < 0:
            value[rows] = -g / (h + 1)
            return
        _, i, k = best
        left = codes[rows, i] <= k
        for part, below in ((rows[left], True), (rows[~left], False)):
            path = (*terms, (i, below, float(cuts[i][k])))
            rules.append(Rule(path))
            split(part, path, depth + 1)

    split(np.arange(len(x)), (), 0)
    return rules, value


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient on the mean logistic loss; the bias has no penalty."""
    n = len(y)
    full = np.hstack([np.ones((n, 1), np.float32), a.astype(np.float32)])
    base = y.mean()
    most = np.abs(full[:, 1:].T @ (y - base)).max() / n if a.shape[1] else 0.0
    v = np.ones(full.shape[1], np.float32)
    for _ in range(20):
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / float(np.linalg.norm(full @ v) ** 2) / 1.05
    b = np.zeros(full.shape[1])
    b[0] = math.log(base / (1 - base))
    z, t = b.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(full @ z.astype(np.float32))))
        new = z - rate * (full.T @ (p - y).astype(np.float32)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty * most, 0)
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        z, b, t = new + (t - 1) / t2 * (new - b), new, t2
    return float(b[0]), b[1:]


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """The ensemble for statistics x and labels y (0 or 1). With no or one kind of labels it is a constant: (ones + 1) / (rows + 2)."""
    base = (y.sum() + 1) / (len(y) + 2)
    constant = RuleEnsemble(math.log(base / (1 - base)), ())
    if len(y) == 0 or y.min() == y.max():
        return constant
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, CUTS + 2)[1:-1])) for i in range(x.shape[1])]
    cuts = [c[c < x[:, i].max()] for i, c in enumerate(cuts)]
    codes = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1)
    raw, rules = np.full(len(y), constant.bias), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        new, value = grow(x, cuts, codes, p - y, p * (1 - p))
        rules |= dict.fromkeys(new)
        raw = raw + STEP * value
        if not new:
            break
    distinct: dict[bytes, Rule] = {}
    for r in rules:
        distinct.setdefault(np.packbits(r.holds(x)).tobytes(), r)
    chosen = list(distinct.values())
    if not chosen:
        return constant
    bias, weights = lasso_logistic(np.stack([r.holds(x) for r in chosen], axis=1), y)
    return RuleEnsemble(bias, tuple((r, float(w)) for r, w in zip(chosen, weights, strict=True) if abs(w) > 1e-6))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", condition: Column | None = None, sample: int = SAMPLE) -> RuleEnsemble:
    """Fits the ensemble on at most about `sample` labelled rows, those with the smallest hashes of their ids. Labels that are null or not
    0 or 1 are passed over; an id with several labels gives an example for each, and so does one with several rows, of which the rows with the
    smallest hashes count if there are more than `sample` in all. Null and empty texts have the statistics of an empty one; the order of rows
    plays no part; without labelled rows, or with one label only, all texts have the same score. condition: on the labels' columns."""
    known = labels if condition is None else labels.where(condition)
    known = known.select(known[label_id].alias("_label_id"), known[label_col].cast("double").alias("_label")).where("_label in (0, 1) and _label_id is not null")
    # Ids with hashes below a share of all that a little more than `sample` have; so parts send few rows to the task that takes the smallest.
    share = min(1.0, (1.2 * sample + 500) / max(1, known.count()))
    known = known.withColumn("_place", F.xxhash64("_label_id")).where(F.col("_place") <= F.lit(int((2 * share - 1) * (2**63 - 1024))))
    known = known.orderBy("_place", "_label_id").limit(sample).drop("_place")
    texts = df.select(df[id_col].alias("_id"), df[text_col].alias("_text")).join(F.broadcast(known), F.col("_id") == F.col("_label_id"))
    columns = [f"_s_{s}" for s in STATISTICS]
    rows = with_statistics(texts, {"_id": F.col("_id"), "_label": F.col("_label")}, "_text")
    # An id may stand on any number of rows; each task passes on `sample` of them at most.
    got = rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(sample).toPandas().sort_values(["k0", "k1", *columns])
    return fit_rules(got[columns].to_numpy(np.float64), got["k1"].to_numpy(np.float64))


def score(df: DataFrame, model: RuleEnsemble, keep: dict[str, Column], text_col: str = "text", name: str = "score") -> DataFrame:
    """The columns `keep` and the score (as `name`), between 0 and 1, for every row; empty and null texts have the statistics of an empty text,
    rows that repeat the same score, and an empty table none."""
    scored = with_statistics(df, keep, text_col)
    return scored.select(*(F.col(f"k{i}").alias(n) for i, n in enumerate(keep)), model.score().alias(name))


def keep_good(df: DataFrame, model: RuleEnsemble, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df, with all their columns, whose score is at least the threshold. Null and empty texts are scored as empty ones; rows
    that repeat share their fate; columns may have any names."""
    scored = with_statistics(df, {c: df[quoted(c)] for c in df.columns}, text_col)
    return scored.where(model.score() >= threshold).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(df.columns)))
