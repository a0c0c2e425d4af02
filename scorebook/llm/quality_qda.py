"""Quality scores from a regularised quadratic discriminant over transformed document statistics.

``statistics`` reads every whole text once (numpy over Arrow buffers) and gives a short vector per document: length,
shares of letter case, digits, symbols and separators, word lengths, repeats of words and lines; shares and counts
are log-transformed so that each class is nearer a Gaussian. Class means and covariances come from one distributed
sum of products over all labelled rows (no sample); the covariances are shrunk towards the pooled diagonal. A
score is the posterior of class 1 from the difference of Mahalanobis log densities; the Cholesky factors are computed
once and travel with the model.

Defined results: null and empty texts have the statistics of an empty text and are scored like any other. Labels
that are null or not 0/1 are not learned from. With a class missing, the score is the other class's constant.
Repeated rows, ties and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Roller, Texts, leased, space_words, text_slices, word_spans

# The statistics, in order.
STATISTICS = (
    "log_bytes", "log_words", "mean_word", "long_words", "upper", "digit", "mark", "bar_words", "punct_end",
    "newline", "distinct_words", "stutter", "repeated_lines", "wide_bytes", "top_mark",
)
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b"#$%&*!|@^~=+<>\\/_{}[]")] = True
_END = np.zeros(256, dtype=bool)
_END[list(b"#$%&*!|@^~=+<>")] = True


@dataclass(frozen=True)
class QdaConfig:
    shrinkage: float = 0.1  #: weight of the pooled diagonal in each class covariance
    floor: float = 1e-3  #: least variance
    temper: float = 0.5  #: factor on the log-density difference, for soft scores


@dataclass
class QdaModel:
    means: dict[int, np.ndarray]
    factors: dict[int, np.ndarray]  #: lower Cholesky factors of the shrunk covariances
    log_dets: dict[int, float]
    log_priors: dict[int, float]


def document_statistics(texts: Texts, roller: Roller) -> np.ndarray:
    """(documents, len(STATISTICS)) over whole texts."""
    n, data, off = len(texts), texts.data, texts.offsets
    size = np.diff(off).astype(float)
    one = np.maximum(size, 1.0)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[off[1:]] - total[off[:-1]]).astype(float)

    starts, ends, first = space_words(texts)
    words = np.diff(first).astype(float)
    w1 = np.maximum(words, 1.0)
    owner = np.repeat(np.arange(n), np.diff(first))
    length = (ends - starts).astype(float)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=n)

    h = roller.spans(data, starts, ends)
    by = np.lexsort((h, owner))
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[by][1:] != h[by][:-1]) | (owner[by][1:] != owner[by][:-1])
    distinct = np.bincount(owner[by][fresh], minlength=n)
    stutter = np.zeros(len(h))
    stutter[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])

    ls, le, lf = word_spans(data, off, data != 10)
    line_owner = np.repeat(np.arange(n), np.diff(lf))
    lh = roller.spans(data, ls, le)
    lby = np.lexsort((lh, line_owner))
    seen = np.zeros(len(lh), dtype=bool)
    seen[1:] = (lh[lby][1:] == lh[lby][:-1]) & (line_owner[lby][1:] == line_owner[lby][:-1])
    again = np.bincount(line_owner[lby], weights=seen * (le - ls)[lby], minlength=n)

    marks = per_text(_MARKS[data])
    top = np.zeros(n)
    for c in b"#$%&*!|":
        top = np.maximum(top, per_text(data == c))
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)

    def share(x, of):
        return np.log(x / of + 0.002)

    return np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(per_word(length) / w1), share(per_word(length > 14), w1),
        share(per_text(upper), np.maximum(per_text(upper | lower), 1.0)), share(per_text((data >= 48) & (data <= 57)), one),
        share(marks, one), share(per_word((length == 1) & (data[starts] == 124)) if len(starts) else np.zeros(n), w1),
        share(per_word(_END[data[ends - 1]]) if len(ends) else np.zeros(n), w1), share(per_text(data == 10), one),
        distinct / w1, share(per_word(stutter), w1), share(again, one), share(per_text(data >= 128), one), share(top, one),
    ])


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<double>) of every row of (doc_id, text)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(11)
        for batch in batches:
            parts = [document_statistics(t, roller) for t in text_slices(batch.column("text"))]
            x = np.vstack(parts) if parts else np.zeros((0, len(STATISTICS)))
            flat = pa.array(x.reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "stats"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return picked.mapInArrow(leased("text", measure), "doc_id long, stats array<double>")


def fit(labelled: DataFrame, cfg: QdaConfig = QdaConfig()) -> QdaModel:
    """Class Gaussians from (stats, label) rows: one aggregation of sums and products, one row per class."""
    k = len(STATISTICS)
    s = [F.col("stats")[i] for i in range(k)]
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(s)]
    sums += [F.sum(s[i] * s[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i + 1)]
    rows = labelled.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n"), *sums).collect()
    counts = {r["label"]: r["n"] for r in rows}
    total = sum(counts.values())
    means, scatter = {}, {}
    for r in rows:
        m = np.array([r[f"s{i}"] for i in range(k)]) / r["n"]
        second = np.array([[r[f"p{max(i, j)}_{min(i, j)}"] for j in range(k)] for i in range(k)]) / r["n"]
        means[r["label"]], scatter[r["label"]] = m, second - np.outer(m, m)
    model = QdaModel(means, {}, {}, {})
    if not rows:
        return model
    pooled = sum(counts[c] * np.clip(np.diag(scatter[c]), 0, None) for c in counts) / total
    for c in counts:
        cov = (1 - cfg.shrinkage) * scatter[c] + cfg.shrinkage * np.diag(pooled) + cfg.floor * np.eye(k)
        model.factors[c] = np.linalg.cholesky(cov)
        model.log_dets[c] = 2 * float(np.log(np.diag(model.factors[c])).sum())
        model.log_priors[c] = float(np.log(counts[c] / total))
    return model


def posterior(model: QdaModel, x: np.ndarray, cfg: QdaConfig) -> np.ndarray:
    """P(class 1) of each row of statistics."""
    if 0 not in model.means or 1 not in model.means:
        return np.full(len(x), 1.0 if 1 in model.means else 0.0 if 0 in model.means else 0.5)
    log_density = {}
    for c in (0, 1):
        y = np.linalg.solve(model.factors[c], (x - model.means[c]).T)
        log_density[c] = model.log_priors[c] - 0.5 * (model.log_dets[c] + (y * y).sum(axis=0))
    diff = np.clip(cfg.temper * (log_density[1] - log_density[0]), -700, 700)
    return 1.0 / (1.0 + np.exp(-diff))


def score(stats: DataFrame, model: QdaModel, cfg: QdaConfig = QdaConfig()) -> DataFrame:
    """Adds ``score`` to (doc_id, stats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(batch.num_rows, len(STATISTICS)) if batch.num_rows else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(posterior(model, x, cfg))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(leased("text", run), "doc_id long, score double")
