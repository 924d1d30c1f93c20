"""Quality classifier (operator 8): regularised quadratic discriminant analysis.

Each document becomes a vector of transformed statistics of its whole text. Each class is a
normal law whose covariance is shrunk towards the pooled one and towards a multiple of the
identity. A document's evidence is the difference of the two log densities, each from a
Mahalanobis distance through a Cholesky factor that is computed once. A monotone logistic
curve fitted to the training rows' evidence turns it into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.llm.tables import crc_of_id, written
from paidpath.llm.words import SPACED, list_array, span_hashes, spans, text_chunks


def _class_of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


KINDS = {
    "upper": _class_of(bytes(range(65, 91))), "lower": _class_of(bytes(range(97, 123))), "digit": _class_of(b"0123456789"),
    "shout": _class_of(b"!"), "symbol": _class_of(b"#$%&*@^~+=<>{}[]\\_/`"), "bar": _class_of(b"|"), "stop": _class_of(b".,;:?"),
    "line": _class_of(b"\n"),
}
FEATURES = ("length", "word_length", "upper", "digit", "shout", "symbol", "bar", "stop", "line", "distinct", "twice", "commonest", "lines_again")


def statistics(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(docs) - 1
    starts, ends, first = spans(data, docs, SPACED)
    words = span_hashes(data, starts, ends)
    total = np.zeros(len(data) + 1, np.int64)
    count = {}
    for kind, admitted in KINDS.items():
        np.cumsum(admitted[data], out=total[1:])
        count[kind] = np.diff(total[docs]).astype(float)
    np.cumsum(ends - starts, out=(size := np.zeros(len(starts) + 1, np.int64))[1:])
    n_words, letters = np.diff(first).astype(float), np.diff(size[first]).astype(float)
    again = np.zeros(len(words) + 1, np.int64)
    if len(words):
        same = np.concatenate([[False], words[1:] == words[:-1]])
        same[first[:-1][np.diff(first) > 0]] = False
        np.cumsum(same, out=again[1:])
    breaks = ~KINDS["line"]
    l_starts, l_ends, l_first = spans(data, docs, breaks)
    lines = span_hashes(data, l_starts, l_ends, lower=False)
    distinct, commonest, lines_again = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        if first[i + 1] > first[i]:
            _, c = np.unique(words[first[i]:first[i + 1]], return_counts=True)
            distinct[i], commonest[i] = len(c), c.max()
        if (k := l_first[i + 1] - l_first[i]) > 1:
            lines_again[i] = 1 - len(np.unique(lines[l_first[i]:l_first[i + 1]])) / k
    w = n_words + 8  # a few words weigh little
    return np.stack([
        np.log(w), np.log((letters + 40) / w), np.sqrt((count["upper"] + 0.5) / (count["upper"] + count["lower"] + 20)),
        np.sqrt(count["digit"] / w), np.sqrt(count["shout"] / w), np.sqrt(count["symbol"] / w), np.sqrt(count["bar"] / w),
        np.sqrt(count["stop"] / w), np.sqrt(count["line"] / w), np.log(distinct + 8) / np.log(w),
        np.sqrt(np.diff(again[first]) / w), np.sqrt(np.maximum(0, commonest - 1) / w), lines_again], axis=1)


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for every row; a null text counts as empty."""
    def compute(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column("text")):
                x = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i),
                                                  list_array(pa.array(x.ravel()), np.arange(len(x) + 1) * x.shape[1])], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(compute, "doc_id long, x array<double>")


class Discriminant:
    """Two shrunken normal laws. ``moments``: for each label the count, sum and sum of outer
    products of its rows."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = 0.3, ridge: float = 0.05):
        d = len(next(iter(moments.values()))[1])
        means = {c: s / n for c, (n, s, _) in moments.items()}
        covs = {c: q / n - np.outer(means[c], means[c]) for c, (n, _, q) in moments.items()}
        total = sum(n for n, _, _ in moments.values())
        within = sum(n * covs[c] for c, (n, _, _) in moments.items()) / total
        self.scale = np.sqrt(np.maximum(np.diag(within), 1e-8))  # so that shrinking treats all statistics alike
        self.laws = {}
        for c, (n, _, _) in moments.items():
            # few rows are shrunk more
            w = max(pooled, d / (n + d))
            s = ((1 - w) * covs[c] + w * within) / np.outer(self.scale, self.scale)
            s = (1 - ridge) * s + ridge * np.trace(s) / d * np.eye(d)
            factor = np.linalg.cholesky(s + 1e-9 * np.eye(d))
            self.laws[c] = (means[c], np.linalg.inv(factor), -np.log(np.diag(factor)).sum() + np.log(n / total))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """log density of label 1 less that of label 0, with the priors."""
        density = {}
        for c, (mean, inverse, constant) in self.laws.items():
            z = ((x - mean) / self.scale) @ inverse.T
            density[c] = constant - 0.5 * np.einsum("ij,ij->i", z, z)
        return density[1] - density[0]


def squeeze(evidence: np.ndarray) -> np.ndarray:
    """Evidence on a scale on which far outliers count little."""
    return np.arcsinh(evidence / 2)


def fit_curve(at: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through binned labels (Newton's method, with
    a weak pull to slope 1)."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * at + offset, -30, 30)))
        n, g = n0 + n1, n1 - (n0 + n1) * p
        w = n * p * (1 - p)
        h = np.array([[(w * at * at).sum() + 1, (w * at).sum()], [(w * at).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(g * at).sum() - (slope - 1), g.sum() - 1e-3 * offset])
        slope, offset = max(0.05, slope + step[0]), offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Learns from all rows of ``labels`` (doc_id, quality) whose crc32(doc_id) mod 5 is not 0
    and whose quality is 0 or 1; other labels, and null ids, are left out. Repeated label
    rows count once, contradicting ones both. A null text counts as empty and gets a score.
    Without labels of one kind, every score is the share of label 1 (0.5 without any)."""
    rows = written(features(docs.select(F.col("doc_id").cast("long"), "text")), "features")
    fold = F.pmod(crc_of_id(), F.lit(5))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where("y IN (0, 1) AND doc_id IS NOT NULL").distinct())
    train = written(rows.join(known, "doc_id").where(fold != 0).select("y", "x"), "train")
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = [F.col("x")[i] for i in range(d)]
    sums = train.groupBy("y").agg(F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
                                  F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("q")).collect()
    moments = {}
    for r in sums:
        outer = np.zeros((d, d))
        for (i, j), v in zip(pairs, r["q"], strict=True):
            outer[i, j] = outer[j, i] = v
        moments[r["y"]] = (float(r["n"]), np.array(r["s"]), outer)
    spark = docs.sparkSession
    if len(moments) == 2:
        told = spark.sparkContext.broadcast(Discriminant(moments))

        def weigh(column):
            def compute(batches):
                for batch in batches:
                    x = np.asarray(batch.column("x").flatten()).reshape(-1, d)
                    yield pa.RecordBatch.from_arrays([batch.column(column), pa.array(squeeze(told.value.evidence(x)))], names=[column, "e"])
            return compute

        bins = train.mapInArrow(weigh("y"), "y int, e double").groupBy(F.round(F.col("e") * 50).alias("b")).agg(
            F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1")).collect()
        at = np.array([r["b"] / 50 for r in bins])
        slope, offset = fit_curve(at, np.array([float(r["n0"]) for r in bins]), np.array([float(r["n1"]) for r in bins]))
        scored = rows.mapInArrow(weigh("doc_id"), "doc_id long, e double")
        score = 1 / (1 + F.exp(-(F.col("e") * slope + offset)))
    else:
        total = sum(n for n, _, _ in moments.values())
        scored = rows
        score = F.lit(float(moments[1][0] / total if 1 in moments else 0.0) if total else 0.5)
    return scored.select("doc_id", (fold == 0).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
