"""Quality classifier: supervised subword embeddings.

Every word and every character n-gram of a text is hashed to one of ``BUCKETS`` learned
vectors.  A document is the mean of its word vectors plus the mean of its n-gram vectors;
a softmax over a linear layer gives the class.  Two reserved entries stand for words that
repeat the word before them and for three-word runs met elsewhere in the same text.

Fitting runs in numpy on the driver, over a sample whose size is bounded by
``SAMPLE_PER_CLASS``; features of that sample are made on the executors.  Scoring is one
narrow pass: since the model is linear over the mean, each bucket's vector folds into one
number, and the folded table (``BUCKETS`` float32, 256 KB) is all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, text_or_empty

BUCKETS = 1 << 16
GRAMS = (3, 4)
DIMENSIONS = 8
#: At most so many labelled documents of either class are learned from, the least by hash of the id.
SAMPLE_PER_CLASS = 1500
EPOCHS, BATCH, RATE = 12, 32, 0.35
#: Texts are hashed together until they hold so many bytes; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))
_REPEATED_WORD, _REPEATED_RUN = 0, 1


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _top16(x: np.ndarray) -> np.ndarray:
    return (((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64)


def blocks(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of encoded texts of about BLOCK_BYTES, with the place of the first."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        if held and size + len(raw) > BLOCK_BYTES:
            yield at, held
            at, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield at, held


def block_features(raws: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple, np.ndarray]:
    """Hashed features of some texts.

    Returns [(bucket at each byte, number of n-grams of each text)] for each n-gram size,
    (word buckets, words of each text), and two rates of repetition for each text.
    """
    sizes = np.array([len(r) for r in raws], np.int64)
    data = np.frombuffer(b"".join(raws) + b" " * max(GRAMS), np.uint8)
    n = int(sizes.sum())
    grams = []
    wide = data.astype(np.uint32)
    for k in GRAMS:
        packed = wide[:n].copy()
        for j in range(1, k):
            packed |= wide[j : n + j] << np.uint32(8 * j)
        packed = (packed * np.uint32(2654435761) + np.uint32(k * 0x25EBCA6B))
        packed ^= packed >> np.uint32(15)
        grams.append((((packed * np.uint32(0x2C1B3C6D)) >> np.uint32(16)).astype(np.int64), np.maximum(sizes - k + 1, 0)))
    # words: runs of bytes that are no ASCII white space; a text's end ends its last word
    ends_at = np.cumsum(sizes)
    space = (data[:n] == 32) | ((data[:n] >= 9) & (data[:n] <= 13))
    inside = ~space
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    first = np.zeros(n + 1, bool)
    first[ends_at - sizes] = True
    starts = np.nonzero(inside & (~before | first[:n]))[0]
    last = np.zeros(n + 1, bool)
    last[ends_at] = True
    after = np.concatenate([inside[1:], [False]]) if n else inside
    ends = np.nonzero(inside & (~after | last[1 : n + 1]))[0] + 1
    owner = np.searchsorted(ends_at, starts, side="right")
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data[:n].astype(np.uint64) + np.uint64(1)) * _powers(_R, n))])
    word = (sums[ends] - sums[starts]) * _powers(_R_INVERSE, n + 1)[starts]
    counts = np.bincount(owner, minlength=len(raws)) if len(starts) else np.zeros(len(raws), np.int64)
    same = np.zeros((len(raws), 2))
    if len(word) > 1:
        twice = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
        same[:, _REPEATED_WORD] = np.bincount(owner[1:][twice], minlength=len(raws))
    if len(word) > 2:
        run = word[:-2] * np.uint64(3) + word[1:-1] * np.uint64(0x100000001B3) + word[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
        whole = owner[2:] == owner[:-2]
        run = (run + owner[2:].astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD))[whole]
        _, place, times = np.unique(run, return_inverse=True, return_counts=True)
        same[:, _REPEATED_RUN] = np.bincount(owner[2:][whole][times[place] > 1], minlength=len(raws))
    same /= np.maximum(counts, 1)[:, None]
    return grams, (np.maximum(_top16(word), 2), counts), same


def _sums(values: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[starts + counts] - total[starts]


@dataclass(frozen=True)
class Model:
    """The folded model: one weight a bucket and a bias; sums of means give the log odds of class 1."""

    weights: np.ndarray
    bias: float

    def log_odds(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for at, raws in blocks(texts):
            grams, (words, counts), same = block_features(raws)
            sizes = np.array([len(r) for r in raws], np.int64)
            starts = np.cumsum(sizes) - sizes
            z = sum(_sums(self.weights[b], c, starts) for b, c in grams) / np.maximum(sum(c for _, c in grams), 1)
            z = z + _sums(self.weights[words], counts, np.cumsum(counts) - counts) / np.maximum(counts, 1)
            out[at : at + len(raws)] = z + same @ self.weights[:2] + self.bias
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(texts), -60, 60)))


def sparse_features(texts: list[str]) -> list[tuple[bytes, bytes]]:
    """For each text its buckets (uint16) and their weights in the mean (float32), as bytes."""
    out = []
    for _, raws in blocks(texts):
        grams, (words, counts), same = block_features(raws)
        sizes = np.array([len(r) for r in raws], np.int64)
        starts, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        total = np.maximum(sum(c for _, c in grams), 1)
        for i in range(len(raws)):
            parts = [b[starts[i] : starts[i] + c[i]] for b, c in grams]
            w = np.bincount(np.concatenate(parts), minlength=BUCKETS) / total[i]
            w += np.bincount(words[first[i] : first[i] + counts[i]], minlength=BUCKETS) / max(counts[i], 1)
            w[:2] += same[i]
            kept = np.nonzero(w)[0]
            out.append((kept.astype(np.uint16).tobytes(), w[kept].astype(np.float32).tobytes()))
    return out


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Stochastic gradient descent on the weighted softmax loss, steps scaled by each bucket's past gradients.

    ``prior`` is the share of class 1 among all labelled rows; examples are weighted so that
    a sample with other shares still gives calibrated scores.  No example: all scores 0.5.
    One class alone: a constant score.
    """
    if not len(labels):
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    share = float(np.mean(labels))
    if share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS, np.float32), 4.0 if share else -4.0)
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.log(np.array([1 - prior, prior]))
    past_t, past_l = np.full(BUCKETS, 1e-8), 1e-8
    onehot = np.eye(2)[labels.astype(int)]
    steps, step = EPOCHS * -(-len(labels) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            batch = order[i : i + BATCH]
            idx = np.concatenate([examples[j][0] for j in batch]).astype(np.int64)
            w = np.concatenate([examples[j][1] for j in batch]).astype(np.float64)
            seg = np.repeat(np.arange(len(batch)), [len(examples[j][0]) for j in batch])
            mean = np.stack([np.bincount(seg, w * table[idx, d], minlength=len(batch)) for d in range(DIMENSIONS)], axis=1)
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - onehot[batch]) * weight[batch, None] / len(batch)
            rate = RATE * (1 - step / steps) + 1e-3
            back = g @ layer.T
            # only the buckets of the batch have a gradient
            met, at = np.unique(idx, return_inverse=True)
            grad = np.stack([np.bincount(at, w * back[seg, d], minlength=len(met)) for d in range(DIMENSIONS)], axis=1)
            past_t[met] += (grad**2).mean(axis=1)
            table[met] -= rate * grad / np.sqrt(past_t[met])[:, None]
            grad_l = mean.T @ g
            past_l += float((grad_l**2).mean())
            layer -= rate * grad_l / np.sqrt(past_l)
            bias -= 0.1 * g.sum(axis=0)
            step += 1
    difference = layer[:, 1] - layer[:, 0]
    return Model((table @ difference).astype(np.float32), float(bias[1] - bias[0]))


def learning_rows(labels: DataFrame, id_col: str = "doc_id") -> F.Column:
    """True where a label may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from the labelled documents that ``learning_rows`` lets through.

    Rows with a null id or a label other than 0 and 1 teach nothing; an id with both labels
    counts in both classes.  At most SAMPLE_PER_CLASS documents of a class are used.
    """
    rows = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & learning_rows(labels, id_col))
        .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
        .distinct()
    )
    shares = {r["__y"]: r["count"] for r in rows.groupBy("__y").count().collect()}
    chosen = [rows.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE_PER_CLASS) for y in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    # bounded by SAMPLE_PER_CLASS, so broadcast
    texts = docs.select(F.col(id_col).alias("__doc"), text_or_empty(text_col).alias("__text")).join(F.broadcast(sample), F.col("__doc") == F.col("__id"))

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = sparse_features(list(pdf["__text"]))
            yield pd.DataFrame({"id": pdf["__id"], "y": pdf["__y"], "b": [x[0] for x in found], "w": [x[1] for x in found]})

    made = texts.select("__id", "__y", "__text").mapInPandas(featurise, "id long, y int, b binary, w binary")
    # repeated ids would lift the bound: one text for each id and label
    made = made.groupBy("id", "y").agg(F.min(F.struct("b", "w")).alias("x")).select("id", "y", "x.b", "x.w").toPandas()
    made = made.sort_values(["id", "y"], ignore_index=True)
    examples = [(np.frombuffer(b, np.uint16), np.frombuffer(w, np.float32)) for b, w in zip(made["b"], made["w"])]
    total = sum(shares.values())
    return train(examples, made["y"].to_numpy(), shares.get(1, 0) / total if total else 0.5)


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the chance of label 1 from each whole text; null texts count as empty.

    Empty tables give empty results, repeated rows equal scores; if a column of that name is
    there, the new one gets underscores in front.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Model(*shared.value)
        for t in texts:
            yield pd.Series(held.scores(list(t)))

    return docs.withColumn(free_name(docs, into), scored(text_or_empty(text_col)))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that score ``least`` or more, same columns."""
    tmp = free_name(docs, "__score")
    return score(docs, fit(docs, labels, id_col, text_col), text_col, tmp).where(F.col(tmp) >= least).drop(tmp)
