"""URL filters: allow and block rules first, then gradient-boosted trees on lexical features of the URL.

The trees are trained here, from the URLs that a rule labels.  Prediction reads nothing but the URL.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import tidy

#: (verdict, host suffix, path prefix)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

N_STATIC = 12


def _static(url: str, host: str, path: str) -> list[float]:
    n = max(1, len(url))
    counts = Counter(url)
    query = url.partition("#")[0].partition("?")[2]
    labels = [x for x in host.split(".") if x]
    return [
        len(url), len(host), len(path),
        len([x for x in path.split("/") if x]), len(labels),
        sum(c.isdigit() for c in url) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        query.count("&") + 1 if query else 0,
        url.count("#"), url.count("-") + url.count("_"), sum(not c.isalnum() for c in url) / n,
        max(map(len, re.findall(r"\d+", path)), default=0),
    ]


def suffixes(host: str, path: str) -> tuple[str, str, str]:
    """What suffix statistics are kept for: the last label of the host, its last two, the file ending or last mark of the path."""
    labels = [x for x in host.split(".") if x]
    last = path.rsplit("/", 1)[-1]
    ending = last.rsplit(".", 1)[-1] if "." in last else "/" if path.endswith("/") else ""
    return (labels[-1] if labels else "", ".".join(labels[-2:]), ending)


@dataclass
class UrlModel:
    """Boosted regression trees under logistic loss; ``stats`` has the share of blocked URLs by suffix, shrunk to the whole.

    The trees are fitted on statistics of the other folds, so that a row's own label is in none of its features.
    """

    prior: float = 0.5
    stats: list[dict[str, tuple[float, float]]] = field(default_factory=lambda: [{}, {}, {}])
    bias: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    depth: int = 3

    def features(self, rows: list[tuple[str, str, str]]) -> np.ndarray:
        out = np.zeros((len(rows), N_STATIC + 6))
        for i, (url, host, path) in enumerate(rows):
            out[i, :N_STATIC] = _static(url, host, path)
            for k, s in enumerate(suffixes(host, path)):
                out[i, N_STATIC + 2 * k : N_STATIC + 2 * k + 2] = self.stats[k].get(s, (self.prior, 0.0))
        return out

    def fit(self, rows: list[tuple[str, str, str]], blocked: np.ndarray, rounds: int = 40, rate: float = 0.2, bins: int = 32, folds: int = 5) -> UrlModel:
        if not len(rows):
            return self
        y = np.asarray(blocked, float)
        self.prior = float(np.clip(y.mean(), 0.01, 0.99))
        ends = [suffixes(h, p) for _, h, p in rows]
        fold = np.arange(len(rows)) % folds
        x = np.zeros((len(rows), N_STATIC + 6))
        for f in range(folds):
            self.stats = self._stats(ends, y, fold != f)
            x[fold == f] = self.features([rows[i] for i in np.flatnonzero(fold == f).tolist()])
        self.stats = self._stats(ends, y, fold >= 0)
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
        self.bias = math.log(self.prior / (1 - self.prior))
        score = np.full(len(y), self.bias)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._tree(binned, cuts, y - p, p * (1 - p), bins)
            tree = (tree[0], tree[1], tree[2] * rate)
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _stats(self, ends: list[tuple[str, str, str]], y: np.ndarray, use: np.ndarray) -> list[dict[str, tuple[float, float]]]:
        out = []
        for k in range(3):
            n, bad = Counter(), Counter()
            for i in np.flatnonzero(use).tolist():
                n[ends[i][k]] += 1
                bad[ends[i][k]] += y[i]
            out.append({s: ((bad[s] + 5 * self.prior) / (n[s] + 5), math.log1p(n[s])) for s in n})
        return out

    def _tree(self, binned, cuts, grad, hess, bins):
        n_in = 2**self.depth - 1
        feat, cut, node = np.full(n_in, -1), np.full(n_in, np.inf), np.zeros(len(grad), int)
        for at in range(n_in):
            rows = np.flatnonzero(node == at)
            best = (1e-6, -1, 0)
            g, h = grad[rows].sum(), hess[rows].sum()
            for f in range(binned.shape[1]) if len(rows) > 20 else ():
                gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], bins + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], bins + 1))[:-1]
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                k = int(np.argmax(gain))
                if gain[k] > best[0] and k < len(cuts[f]):
                    best = (gain[k], f, k)
            _, f, k = best
            right = binned[rows, f] > k if f >= 0 else np.zeros(len(rows), bool)
            if f >= 0:
                feat[at], cut[at] = f, cuts[f][k]
            node[rows] = 2 * at + 1 + right
        leaf = node - n_in
        total, weight = np.bincount(leaf, grad, n_in + 1), np.bincount(leaf, hess, n_in + 1)
        return (feat, cut, total / (weight + 1)), leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability that a URL is to be blocked."""
        score = np.full(len(x), self.bias)
        for feat, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                f = feat[node]
                right = (f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > cut[node])
                node = 2 * node + 1 + right
            score += value[node - len(feat)]
        return 1 / (1 + np.exp(-score))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path; both empty for null or where there is no ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, lower).otherwise(""), F.when(has, path).otherwise("")


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none fits.  Of rules of one length the first listed wins."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (name, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, train_rows: int = 10_000, threshold: float = 0.5) -> DataFrame:
    """Judge every URL: by the longest rule that fits, else by the trees.

    The trees learn from at most ``train_rows`` different URLs that a rule labels, the ones chosen by a hash of the URL.
    Returns the id, ``host``, ``path``, ``rule``, ``verdict`` and ``p_block`` (null where a rule decides).  A null,
    empty or odd URL has an empty host and path and is judged by the trees; with no labelled URL at all every
    other URL is allowed.  A URL of any length is read whole.  Of rules of one length the first listed wins; a
    probability of exactly ``threshold`` blocks.  Repeated rows give repeated results; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    host, path = url_parts(F.col("_url"))
    base = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
    base = base.withColumns({"host": host, "path": path})
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "_ruled": verdict})
    labelled = base.filter("_ruled is not null").select("_url", "host", "path", "_ruled")
    # Different URLs: one that stands very often is one of them.  A share by hash first, somewhat over what is wanted, so
    # that no task sends all it has to the driver.
    scale, n = 1 << 20, max(1, labelled.agg(F.count_distinct("_url")).first()[0])
    share = min(scale, -(-scale * train_rows * 5 // (4 * n)))
    picked = labelled.filter(F.pmod(F.xxhash64("_url", F.lit(5)), F.lit(scale)) < share).distinct()
    sample = picked.orderBy(F.xxhash64("_url"), "_url").limit(train_rows).collect()  # bounded by train_rows
    model = UrlModel().fit([(r[0], r[1], r[2]) for r in sample], np.array([r[3] == "block" for r in sample]))

    def judge(batches):
        for b in batches:
            url, hosts, paths, ruled = (b.column(i).to_pylist() for i in (1, 2, 3, 5))
            free = [i for i, r in enumerate(ruled) if r is None]
            p: list = [None] * b.num_rows
            if free:
                got = model.predict(model.features([(url[i] or "", hosts[i], paths[i]) for i in free])) if model.trees else np.zeros(len(free))
                for i, v in zip(free, got, strict=True):
                    p[i] = float(v)
            final = [r if r is not None else "block" if v >= threshold else "allow" for r, v in zip(ruled, p, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), b.column(4), pa.array(final, pa.string()), pa.array(p, pa.float64())],
                names=[id_col, "host", "path", "rule", "verdict", "p_block"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    return base.mapInArrow(tidy(judge), f"`{id_col}` {kind}, host string, path string, rule string, verdict string, p_block double")
