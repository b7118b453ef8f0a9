"""Document statistics and a monotone gradient-boosted model over them, scored from flat node arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import bounded

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Features of the model, with the direction in which quality may change (0: free).
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_a_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "exclaim_a_word": -1, "pipes_a_word": -1, "digit_share": 0, "distinct_share": 0, "line_words": 0, "comma_a_word": 0,
}
UPPER, DIGITS = bytes(range(65, 91)), b"0123456789"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in an 8-word window found twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.zeros(n, np.uint64)
        for j in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15 | 1) + code[j : j + n]
            key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    # Windows with equal keys are few; they are compared word by word.
    maybe = np.unique(np.r_[order[1:][same], order[:-1][same]])
    seen: dict[tuple[bytes, ...], int] = {}
    hit = np.zeros(n, bool)
    for i in maybe.tolist():
        first = seen.setdefault(tuple(words[i : i + WINDOW]), i)
        if first != i:
            hit[first] = hit[i] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[list[int], list[float]]:
    """The five counts of the contract and the model's features."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at 0x20 and 0x09-0x0D only
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(raw.count(s) for s in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    rep = repeat_words(words)
    per = max(n, 1)
    size = max(len(raw), 1)
    features = [
        np.log1p(n), chars / per, symbols / per, dup / max(len(lines), 1), rep / per, (size - len(raw.translate(None, UPPER))) / size if raw else 0.0,
        raw.count(b"!") / per, raw.count(b"|") / per, (len(raw) - len(raw.translate(None, DIGITS))) / size, len(set(words)) / per, n / max(len(lines), 1), raw.count(b",") / per,
    ]
    return [n, chars, symbols, dup, rep], features


@dataclass
class Forest:
    """Trees as flat arrays: row t, column k holds node k of tree t; leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: all rows go down one level of a tree at a time."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                low = x[rows, self.feature[t][node]] <= self.threshold[t][node]
                node = np.where(low, self.left[t][node], self.right[t][node])
            out += self.value[t][node]
        return out


def fit_forest(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Forest:
    """Logistic boosting on binned features. A split on a constrained feature must keep the order of its leaves, and the values
    below each side stay on their side of the middle, so the score is monotone in that feature."""
    nodes = 2 ** (depth + 1) - 1
    shape = (trees, nodes)
    forest = Forest(np.zeros(shape, np.int64), np.full(shape, np.inf), np.tile(np.arange(nodes), (trees, 1)), np.tile(np.arange(nodes), (trees, 1)), np.zeros(shape), depth, 0.0)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.999
    forest.start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return forest
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)  # x <= edge[b] means bin <= b
    raw = np.full(len(y), forest.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        members = {0: np.arange(len(y))}
        bound = {0: (-np.inf, np.inf)}
        for k in range(nodes):
            if k not in members:
                continue
            own = members[k]
            lo, hi = bound[k]
            gs, hs = g[own].sum(), h[own].sum()
            forest.value[t, k] = float(np.clip(gs / (hs + l2), lo, hi))
            if 2 * k + 2 >= nodes or len(own) < 20:
                continue
            best = (1e-6, -1, -1, 0.0, 0.0)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[own, j]
                gl = np.cumsum(np.bincount(b, g[own], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[own], len(e) + 1))[:-1]
                vl, vr = np.clip(gl / (hl + l2), lo, hi), np.clip((gs - gl) / (hs - hl + l2), lo, hi)
                gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                fine = (hl >= least) & (hs - hl >= least)
                if signs[j]:
                    fine &= signs[j] * (vr - vl) >= 0
                gain = np.where(fine, gain, -1)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (float(gain[i]), j, i, float(vl[i]), float(vr[i]))
            _, j, i, vl, vr = best
            if j < 0:
                continue
            forest.feature[t, k], forest.threshold[t, k], forest.left[t, k], forest.right[t, k] = j, edges[j][i], 2 * k + 1, 2 * k + 2
            low = binned[own, j] <= i
            members[2 * k + 1], members[2 * k + 2] = own[low], own[~low]
            mid = (vl + vr) / 2
            bound[2 * k + 1] = (lo, mid) if signs[j] > 0 else (mid, hi) if signs[j] < 0 else (lo, hi)
            bound[2 * k + 2] = (mid, hi) if signs[j] > 0 else (lo, mid) if signs[j] < 0 else (lo, hi)
        forest.value[t] *= rate
        node = np.zeros(len(y), np.int64)
        for _ in range(depth):
            low = x[np.arange(len(y)), forest.feature[t][node]] <= forest.threshold[t][node]
            node = np.where(low, forest.left[t][node], forest.right[t][node])
        raw += forest.value[t][node]
    return forest


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, seed: int = 7) -> Forest:
    """Fit on at most about ``max_labelled`` labelled documents, an even hash sample of all ids with a label (the documented
    bound of the fit). Labels with a null id or quality are left out; an id labelled twice takes its higher label; an id with
    several texts takes the least statistics. Without both classes the model keeps everything."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = known.count()
    part = min(1.0, max_labelled / max(n, 1))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) < int(part * (1 << 40)))

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_stats(t)[1])

    rows = bounded(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", features("text").alias("x"))
    got = rows.groupBy("doc_id").agg(F.min(F.struct("x", "quality")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit_forest(x, got["quality"].to_numpy(float), list(FEATURES.values()))


def apply_rules(docs: DataFrame, forest: Forest, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the counts, base_failed, kept and the model's probability.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated 8-word windows; such rows are never kept. Null text
    counts as empty, so it fails. Repeated rows stay; an empty table gives no rows; other columns are not looked at.
    """
    columns = [*STATS, "quality"]

    @F.pandas_udf(", ".join(f"{c} long" for c in STATS) + ", quality double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            both = [text_stats(t) for t in texts]
            out = pd.DataFrame([b[0] for b in both], columns=list(STATS), dtype="int64")
            x = np.array([b[1] for b in both], float).reshape(-1, len(FEATURES))
            out["quality"] = 1 / (1 + np.exp(-forest.score(x)))
            yield out[columns]

    rows = bounded(docs).select(F.col(id_col).alias("doc_id"), judge(F.col(text_col)).alias("s")).select("doc_id", "s.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", *STATS, failed.alias("base_failed"), (~failed & (F.col("quality") >= least)).alias("kept"), "quality")


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the counts and base_failed of ``apply_rules``, without a model; its edge cases hold."""

    @F.pandas_udf(", ".join(f"{c} long" for c in STATS))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_stats(t)[0] for t in texts], columns=list(STATS), dtype="int64")

    rows = bounded(docs).select(F.col(id_col).alias("doc_id"), count(F.col(text_col)).alias("s")).select("doc_id", "s.*")
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """Train on the labelled part of ``docs`` and judge all of it."""
    return apply_rules(docs, train(docs, labels, max_labelled))
