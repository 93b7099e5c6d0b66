"""Quality rules: document statistics, and gradient-boosted trees over them.

Statistics are counted over whole texts in numpy. The trees are fitted on the
driver on a bounded sample of labelled rows (``TRAIN_ROWS``, those with the
smallest hash of their id), by Newton boosting of the logistic loss on binned
features, and are flattened into node arrays, so scoring walks all rows of a
batch down one level at a time. Monotonic constraints: more of what spoils a
text (symbols, repeated lines or words, capitals, exclamation marks) never
raises its score.

Defined results: a null or empty text has no words and fails the base rules;
labels that are null, or of documents that are absent, teach nothing; without
labels of both kinds the base rules alone decide; rows with equal ids are judged
each; an empty table gives no rows; ``good_documents`` keeps further columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm.common import as_bytes, byte_chunks, save, table
from recoengine.llm.windows import hash_runs, mix, word_codes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Labelled rows that the trees are fitted on, at most.
TRAIN_ROWS = 20_000
THRESHOLD = 0.5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (*BASE, "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks")
#: Feature and the direction that its score may take as it grows (0: any).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "distinct": 0,
            "upper": -1, "digits": 0, "marks": -1, "line_words": 0}


def _per_doc(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each owner, and for each row how often its hash
    occurs in its owner."""
    own = mix(hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, first, inverse, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    return np.bincount(owner[first], minlength=n), count[inverse]


def _is(text: np.ndarray, chars: str) -> np.ndarray:
    wanted = np.zeros(256, dtype=bool)
    wanted[[ord(c) for c in chars]] = True
    return wanted[text]


def count_statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    n = len(texts)
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    codes, at = word_codes(joined)
    lo, hi = np.searchsorted(at, starts), np.searchsorted(at, ends)
    owner = np.repeat(np.arange(n), hi - lo)
    out = {"n_words": hi - lo}
    space = _is(joined, " \t\n\v\f\r")
    out["word_chars"] = _per_doc(((joined & 0xC0) != 0x80) & ~space, starts, ends)
    out["n_symbols"] = _per_doc(_is(joined, "#*$%&|<>"), starts, ends)
    out["n_upper"] = _per_doc((joined >= 65) & (joined <= 90), starts, ends)
    out["n_digits"] = _per_doc((joined >= 48) & (joined <= 57), starts, ends)
    out["n_marks"] = _per_doc(_is(joined, "!?"), starts, ends)
    out["n_distinct_words"] = _distinct(owner, codes, n)[0]

    # three-word windows of one document
    grams = hash_runs(codes, 3, 21)
    inside = owner[:len(grams)] == owner[2:] if len(grams) else np.zeros(0, dtype=bool)
    place = np.flatnonzero(inside)
    often = _distinct(owner[place], grams[place], n)[1] > 1
    cover = np.zeros(len(codes) + 3, dtype=np.int64)
    np.add.at(cover, place[often], 1)
    np.add.at(cover, place[often] + 3, -1)
    out["n_repeat_words"] = _per_doc(np.cumsum(cover)[:len(codes)] > 0, lo, hi)

    lines = [[x for x in t.split(b"\n") if x.split(None, 1)] for t in texts]
    out["n_lines"] = np.array([len(x) for x in lines], dtype=np.int64)
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64)
    return out


def statistics(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, STATISTICS...) of each row."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 4 << 20):
            found = count_statistics(as_bytes(chunk.column("text")))
            yield pa.RecordBatch.from_arrays([chunk.column(key), *[pa.array(found[s], pa.int64()) for s in STATISTICS]],
                                             [key, *STATISTICS])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(kernel, f"{key} {kind}, " + ", ".join(f"{s} long" for s in STATISTICS))


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    return np.stack([np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines,
                     s["n_repeat_words"] / words, s["n_distinct_words"] / words, s["n_upper"] / chars,
                     s["n_digits"] / chars, s["n_marks"] / chars, s["n_words"] / lines], axis=1)


@dataclass
class Trees:
    """Flattened trees: node arrays of all trees end to end. A leaf points to
    itself; ``roots`` are the trees' first nodes."""
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of each row: all trees at once, a level at a time."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, direction: list[int], rounds: int = 40, depth: int = 3, rate: float = 0.2,
              bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Newton boosting of the logistic loss. A split on a constrained feature
    needs its two values in order; children then stay on their side of the
    middle, so the whole tree is monotonic in that feature."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    raw = np.full(len(y), base)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def value(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + ridge), low, high))

    def grow(rows: np.ndarray, level: int, low: float, high: float, grad: np.ndarray, hess: np.ndarray, step: np.ndarray) -> int:
        me = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        mine = value(g, h, low, high)
        nodes.append([0, np.inf, me, me, rate * mine])
        best = (1e-6, -1, -1, 0.0, 0.0)
        for f in range(x.shape[1]) if level < depth and len(rows) >= 2 * least else ():
            size = len(cuts[f]) + 1
            gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], size))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], size))[:-1]
            nl = np.cumsum(np.bincount(binned[rows, f], minlength=size))[:-1]
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(g - gl) / (h - hl + ridge), low, high)
            gain = (-(gl * vl + 0.5 * (hl + ridge) * vl ** 2) - ((g - gl) * vr + 0.5 * (h - hl + ridge) * vr ** 2)
                    + g * mine + 0.5 * (h + ridge) * mine ** 2)
            gain[(nl < least) | (len(rows) - nl < least)] = -np.inf
            if direction[f]:
                gain[direction[f] * (vr - vl) < 0] = -np.inf
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
        _, f, k, vl, vr = best
        if f < 0:
            step[rows] = rate * mine
            return me
        middle = (vl + vr) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[direction[f]]
        under = binned[rows, f] <= k
        left = grow(rows[under], level + 1, *bounds[0], grad, hess, step)
        right = grow(rows[~under], level + 1, *bounds[1], grad, hess, step)
        nodes[me] = [f, cuts[f][k], left, right, 0.0]
        return me

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        step = np.zeros(len(y))
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf, p - y, p * (1 - p), step))
        raw += step
    feature, threshold, left, right, values = (np.array(c) for c in zip(*nodes))
    return Trees(np.array(roots), feature.astype(np.int64), threshold.astype(float), left.astype(np.int64),
                 right.astype(np.int64), values.astype(float), depth, base)


def train(stats: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees | None:
    """Trees for P(quality = 1), from at most ``rows`` labelled documents."""
    known = labels.where("quality is not null").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality"))
    sample = stats.join(known, stats["doc_id"] == known["_id"]).select("_id", "_quality", *STATISTICS)
    sample = sample.orderBy(F.xxhash64(F.lit(10), "_id"), "_id", *STATISTICS, "_quality").limit(rows).toPandas()
    y = sample["_quality"].to_numpy(dtype=float)
    if len(set(y)) < 2:
        return None
    return fit_trees(features({s: sample[s].to_numpy() for s in STATISTICS}), y, list(FEATURES.values()))


def verdict(s: dict[str, np.ndarray], trees: Trees | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, score and kept of each row."""
    failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
    score = trees.score(features(s)) if trees else np.ones(len(failed))
    return failed, score, ~failed & (score >= threshold)


def judged(stats: DataFrame, trees: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with base_failed, score and kept."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = verdict({c: b.column(c).to_numpy() for c in STATISTICS}, trees, threshold)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x) for x in found]],
                                             [*b.schema.names, "base_failed", "score", "kept"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    return stats.mapInArrow(kernel, f"{ddl}, base_failed boolean, score double, kept boolean")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = save(statistics(table(spark, sf_dir, "documents")), "statistics")
    trees = train(stats, table(spark, sf_dir, "labels"))
    return judged(stats, trees).select("doc_id", *BASE, "base_failed", "kept", "score")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their columns. The statistics
    are counted again on the way rather than joined to the texts."""
    trees = train(statistics(docs), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 4 << 20):
            yield chunk.filter(pa.array(verdict(count_statistics(as_bytes(chunk.column("text"))), trees, THRESHOLD)[2]))

    return docs.mapInArrow(keep, docs.schema)
