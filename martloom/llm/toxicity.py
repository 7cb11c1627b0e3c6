"""Toxicity by subword bags: n-gram embeddings averaged into a linear softmax.

A stretch of text is the bag of its words and their character n-grams, each hashed to a bucket with
an embedding. The mean embedding goes into a linear softmax over two classes. Embeddings and softmax
are trained jointly in numpy on a bounded sample of labelled documents, so that a misspelt word that no
label ever held still shares most of its n-grams' vectors with the word it comes from.

Labels mark whole documents, of which a few words may be toxic, so a bag is a window of ``WINDOW``
words (one) and a document is as toxic as its worst window. Training therefore alternates: pick the worst
window of each document under the present model (at first by how many toxic and other documents hold
an n-gram), then fit on those windows; windows of clean documents are kept from round to round. Last, the
worst window's logit is scaled to a probability of the document.

Since both steps after training are linear, a window's logit is a mean of one number per bucket;
scoring gathers those numbers over whole texts in slices of bounded size. The model is ``2**BITS``
floats, whatever the corpus, and goes to the tasks as a broadcast of that size.

The sample holds at most ``2 * max_docs`` documents (about ``max_docs``, toxic and other in a fixed
proportion, by a hash of the id, with weights that restore the true share) of at most ``max_chars``
characters each; their texts go to the driver. Every document is scored as a whole.

Defined results: null and empty texts and texts without a letter get the share of toxic labels as
their score, repeated rows score alike, of several labels of a document the largest counts, without
labels every score is 0 (below 1e-9), an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .subwords import Slice, slices

ORDERS = (3, 4, 5)
BITS = 18
WINDOW = 1


@dataclass
class Model:
    per_bucket: np.ndarray  # of each bucket its share of a window's logit
    slope: float  # from the worst window's logit to the document's
    bias: float
    empty: float  # score of a text without words


def word_sums(part: Slice, per_bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word the sum of its features' numbers and how many features it has."""
    letters = np.zeros(len(part.letters), np.float32)
    found = np.zeros(len(part.letters), np.float32)
    for n in ORDERS:
        buckets, valid = part.grams(n, BITS)
        letters += np.where(valid, per_bucket[buckets], 0)
        found += valid
    return per_bucket[part.words(BITS)] + part.per_word(letters), 1 + part.per_word(found)


def window_logits(sums: np.ndarray, sizes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each word the mean over the window that begins there, or over what its document has left."""
    a = np.concatenate(([0.0], np.cumsum(sums, dtype=np.float64)))
    b = np.concatenate(([0.0], np.cumsum(sizes, dtype=np.float64)))
    last = np.searchsorted(doc, doc, "right")
    end = np.minimum(np.arange(len(doc)) + WINDOW, last)
    at = np.arange(len(doc))
    return (a[end] - a[at]) / (b[end] - b[at])


def worst_windows(texts: list[str], per_bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the largest window logit (-inf without a word) and whether it has words.

    A text of several slices counts the windows of each slice.
    """
    worst = np.full(len(texts), -np.inf)
    for part in slices(texts):
        if len(part.start):
            sums, sizes = word_sums(part, per_bucket)
            logits = window_logits(sums, sizes, part.doc)
            first = np.flatnonzero(np.diff(part.doc, prepend=-1))
            docs = part.doc[first]
            worst[docs] = np.maximum(worst[docs], np.maximum.reduceat(logits, first))
    return worst, np.isfinite(worst)


def features(part: Slice, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of some words, and for each the place of its word in ``words``."""
    place = np.full(len(part.start), -1, np.int64)
    place[words] = np.arange(len(words))
    of_letter = np.repeat(place, part.end - part.start)
    ids, owner = [part.words(BITS)[words]], [np.arange(len(words))]
    for n in ORDERS:
        buckets, valid = part.grams(n, BITS)
        valid &= of_letter >= 0
        ids.append(buckets[valid])
        owner.append(of_letter[valid])
    return np.concatenate(ids), np.concatenate(owner)


def spread(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Per bucket the log odds that a document with it is toxic, by counts of documents."""
    held = np.zeros((2, 1 << BITS), np.float32)
    for part in slices(texts):
        ids, owner = features(part, np.arange(len(part.start)))
        pairs = np.unique(part.doc[owner] << BITS | ids)
        np.add.at(held, (labels[pairs >> BITS], pairs & ((1 << BITS) - 1)), 1)
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    # Five documents' worth of the common share keep what few documents hold from standing out.
    share = (held.sum(0) + 1e-3) / n.sum()
    return np.log((held[1] + 5 * share) / (n[1] + 5)) - np.log((held[0] + 5 * share) / (n[0] + 5))


def pick(texts: list[str], labels: np.ndarray, per_bucket: np.ndarray, rng) -> list[tuple[int, np.ndarray]]:
    """(label, feature buckets) of each text's worst window, and a random one of clean texts."""
    out = []
    for part in slices(texts):
        if not len(part.start):
            continue
        logits = window_logits(*word_sums(part, per_bucket), part.doc)
        first = np.flatnonzero(np.diff(part.doc, prepend=-1))
        ends = np.append(first[1:], len(logits))
        starts, which = [], []
        for a, b in zip(first, ends):
            label = labels[part.doc[a]]
            chosen = [a + int(np.argmax(logits[a:b]))]
            if label == 0:
                chosen.append(int(rng.integers(a, b)))
            for c in chosen:
                starts.append(np.arange(c, min(c + WINDOW, b)))
                which.append(label)
        words = np.unique(np.concatenate(starts))
        ids, owner = features(part, words)
        order = np.argsort(owner, kind="stable")
        ids, bounds = ids[order], np.searchsorted(owner[order], np.arange(len(words) + 1))
        for label, span in zip(which, starts):
            a = np.searchsorted(words, span[0])
            out.append((int(label), ids[bounds[a] : bounds[a + len(span)]]))
    return out


def fit_windows(
    bags: list[tuple[int, np.ndarray]], weight: np.ndarray, rng, dim: int = 16, epochs: int = 5, rate: float = 0.3
) -> np.ndarray:
    """Jointly fits embeddings and softmax; returns the logit's share of each bucket."""
    table = rng.normal(0, 0.05, (1 << BITS, dim)).astype(np.float32)
    soft = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    seen_table, seen_soft = np.full(1 << BITS, 1e-4, np.float32), np.full((dim, 2), 1e-4, np.float32)
    labels = np.array([b[0] for b in bags])
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            sizes = [len(bags[r][1]) for r in rows]
            ids, where = np.unique(np.concatenate([bags[r][1] for r in rows]), return_inverse=True)
            x = np.zeros((len(rows), len(ids)), np.float32)
            np.add.at(x, (np.repeat(np.arange(len(rows)), sizes), where), np.repeat(1 / np.array(sizes, np.float32), sizes))
            z = x @ table[ids]
            logits = z @ soft
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p *= weight[labels[rows]][:, None]
            grad_table, grad_soft = x.T @ (p @ soft.T), z.T @ p
            # One step size per embedding, so that its direction is the gradient's.
            seen_table[ids] += (grad_table**2).mean(1)
            table[ids] -= step * grad_table / np.sqrt(seen_table[ids])[:, None]
            seen_soft += grad_soft**2
            soft -= step * 0.1 * grad_soft / np.sqrt(seen_soft)
    return table @ (soft[:, 1] - soft[:, 0])


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray, rounds: int = 3, seed: int = 7, **options) -> Model:
    """``weights``: of each document, for the share of toxic ones at the end."""
    if not len(texts) or not weights.sum():
        return Model(np.zeros(1 << BITS, np.float32), 0.0, -60.0, 0.0)
    rng = np.random.default_rng(seed)
    share = float((labels * weights).sum() / weights.sum())
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 60.0 if share else -60.0, share)
    per_bucket = spread(texts, labels)
    clean: list[tuple[int, np.ndarray]] = []
    for _ in range(rounds):
        found = pick(texts, labels, per_bucket, rng)
        clean += [x for x in found if x[0] == 0]
        toxic = [x for x in found if x[0] == 1]
        per_class = np.array([1.0, len(clean) / max(1, len(toxic)) / 2], np.float32)
        per_bucket = fit_windows(toxic + clean, per_class, rng, **options)
    worst, has = worst_windows(texts, per_bucket)
    x, y, w = worst[has], labels[has], weights[has] / weights[has].sum()
    slope, bias = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic fit in two numbers, slightly ridged
        p = 1 / (1 + np.exp(-np.clip(slope * x + bias, -30, 30)))
        h = w * np.maximum(p * (1 - p), 1e-6)
        g = np.array([(w * (p - y) * x).sum() + 1e-3 * (slope - 1), (w * (p - y)).sum()])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, g)
        slope, bias = slope - np.clip(move[0], -1, 1), bias - np.clip(move[1], -2, 2)
    return Model(per_bucket.astype(np.float32), float(slope), float(bias), share)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    worst, has = worst_windows(texts, model.per_bucket)
    logit = np.clip(model.slope * np.where(has, worst, 0) + model.bias, -60, 60)
    return np.where(has, 1 / (1 + np.exp(-logit)), model.empty)


def fit(documents: DataFrame, labels: DataFrame, usable: Column, max_docs: int = 4500, max_chars: int = 200_000) -> Model:
    """A model from labelled documents for whose id ``usable`` (of a column ``doc_id``) holds."""
    marks = (
        labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(usable)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    room = {1: max_docs // 3, 0: max_docs - max_docs // 3}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20))
    chosen = F.lit(False)
    for label, most in room.items():
        share = min(1.0, most / max(1, counts.get(label, 0)))
        chosen = chosen | ((F.col("label") == label) & (draw < int((1 << 20) * share)))
    # At most twice the documented bound, whatever the hash does: small enough to send to all tasks.
    sample = F.broadcast(marks.where(chosen).limit(2 * max_docs))
    rows = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(sample, "doc_id")
    held = rows.where(F.length("text") <= max_chars).limit(2 * max_docs).toPandas().sort_values(["doc_id", "text"])
    labels_of = held["label"].to_numpy(np.int64)
    drawn = np.maximum(np.bincount(labels_of, minlength=2), 1)
    weights = np.array([counts.get(k, 0) / drawn[k] for k in (0, 1)])[labels_of]
    return train(list(held["text"]), labels_of, weights)


def score(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, score and prediction for every row of ``documents``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = score_texts([t or "" for t in batch["text"]], shared.value)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInPandas(run, "doc_id string, score double")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
