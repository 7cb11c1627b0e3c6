"""Language of a text, span by span, by script ranges, word scores and Viterbi.

Words are scored per language by hashed character n-grams and the word itself (naive Bayes over
feature counts). The script of a word narrows the languages it may belong to: those that used
the script in training. Viterbi over a text's words, with a penalty for every switch of language,
labels spans; the language with the most letters in its spans is the text's, and its share of all
letters the score.

Counts come from at most about ``max_docs`` labelled documents per language (by a hash of the id), or from all of
them; counting and summing are Spark's, and the model of ``2**BITS`` floats per language goes to the tasks as
a broadcast of that size. Every text is labelled as a whole: words are scored in slices of bounded
size, and Viterbi steps through the words of many texts side by side.

``keep`` also asks whether any learned language explains a text: of its letters, the share in words whose
script a language uses and whose n-grams are as likely in it as those of its own texts, all but the least likely
``RARE`` of their letters, must reach ``EXPLAINED``. Those cutoffs come from every labelled document that may be used.

Defined results: null text and text without a letter is ``und`` with score 0, and so is every text if
nothing was learned; rows with a null language teach nothing; between equal languages the first in
order wins; repeated rows are labelled alike; an empty table gives no rows; further columns are
ignored, or kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, release_memory
from .subwords import Slice, slices

ORDERS = (2, 3)
BITS = 17
UNKNOWN = "und"
# Share of a text's letters that its language must hold for ``keep``: a short text with a line of another
# language passes, a text of three languages in equal parts doesn't.
LEAST = 0.35
# Of a labelled text's letters, those in its language's least likely words; share of a text's letters that must
# lie in more likely words of some language for ``keep``.
RARE, EXPLAINED = 0.01, 0.3
STEPS = 20  # steps of a likelihood's histogram per unit

# Main code point ranges of scripts.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
_EDGES = sorted((a, b, i + 1) for i, ranges in enumerate(SCRIPTS.values()) for a, b in ranges)
_BEGIN, _END, _KIND = (np.array(x) for x in zip(*_EDGES))


def word_scripts(part: Slice) -> np.ndarray:
    """Script of each word by its first letter; 0 for other scripts."""
    first = part.codes[part.start].astype(np.int64)
    at = np.maximum(np.searchsorted(_BEGIN, first, "right") - 1, 0)
    return np.where((first >= _BEGIN[at]) & (first <= _END[at]), _KIND[at], 0)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (buckets, languages): log probability of a feature
    scripts: np.ndarray  # (scripts + 1, languages): whether the language uses the script
    cutoffs: np.ndarray | None = None  # (languages,): mean log probability of n-grams that explains a word


def feature_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all features of some texts by bucket, and words by script."""
    buckets, scripts = np.zeros(1 << BITS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)
    for part in slices(texts):
        if not len(part.start):
            continue
        buckets += np.bincount(part.words(BITS), minlength=1 << BITS)
        for n in ORDERS:
            found, valid = part.grams(n, BITS)
            buckets += np.bincount(found[valid], minlength=1 << BITS)
        scripts += np.bincount(word_scripts(part), minlength=len(SCRIPTS) + 1)
    return buckets, scripts


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            buckets, scripts = feature_counts([t or "" for t in rows["text"]])
            ids = np.flatnonzero(buckets)
            yield pd.DataFrame({"lang": lang, "bucket": ids, "n": buckets[ids]})
            ids = np.flatnonzero(scripts)
            yield pd.DataFrame({"lang": lang, "bucket": -1 - ids, "n": scripts[ids]})


def fit(documents: DataFrame, usable: Column, max_docs: int | None = 4000, explain: bool = True) -> Model:
    """A model from documents with a language for which ``usable`` (of a column ``doc_id``) holds.

    ``max_docs``: counts from about so many documents per language, None for all of them. ``explain``: with the
    cutoffs for ``keep``, which come from all of them.
    """
    rows = documents.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & usable)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 20))

    def sample(most: int | None) -> DataFrame:
        if most is None:
            return rows.select("lang", "text")
        limits = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int((1 << 20) * min(1.0, most / n)))])
        return rows.where(draw < limits[F.col("lang")]).select("lang", "text")

    counts = sample(max_docs).mapInPandas(frugal(_count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    held = counts.toPandas()
    languages = sorted(sizes)
    place = {k: i for i, k in enumerate(languages)}
    table = np.zeros((1 << BITS, len(languages)))
    used = np.zeros((len(SCRIPTS) + 1, len(languages)))
    at, bucket, n = held["lang"].map(place).to_numpy(np.int64), held["bucket"].to_numpy(np.int64), held["n"].to_numpy()
    real = bucket >= 0
    table[bucket[real], at[real]] = n[real]
    used[-1 - bucket[~real], at[~real]] = n[~real]
    table += 0.3
    weights = np.log(table / table.sum(0))
    model = Model(languages, weights.astype(np.float32), used >= 0.01 * np.maximum(used.sum(0), 1))
    if explain:
        model.cutoffs = _cutoffs(rows.select("lang", "text"), model)
    return model


def _cutoffs(rows: DataFrame, model: Model) -> np.ndarray:
    """Per language the likelihood below which the words with ``RARE`` of its texts' letters lie."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                at = shared.value.languages.index(lang)
                for part in slices(list(texts)):
                    if len(part.start):
                        step = np.floor(STEPS * likelihoods(part, gram_scores(part, shared.value))[:, at]).astype(np.int64)
                        steps, place = np.unique(step, return_inverse=True)
                        yield pd.DataFrame({"lang": lang, "step": steps, "n": np.bincount(place, part.end - part.start).astype(np.int64)})

    found = rows.mapInPandas(frugal(run), "lang string, step long, n long").groupBy("lang", "step").agg(F.sum("n").alias("n")).toPandas()
    out = np.full(len(model.languages), -np.inf)
    for lang, steps in found.sort_values("step").groupby("lang"):
        below = steps["n"].cumsum().to_numpy()
        out[model.languages.index(lang)] = steps["step"].to_numpy()[np.searchsorted(below, RARE * below[-1], "right")] / STEPS
    return out


def gram_scores(part: Slice, model: Model) -> np.ndarray:
    """(words, languages): sum of the log probabilities of a word's n-grams."""
    letters = np.zeros((len(part.letters), len(model.languages)), np.float32)
    for n in ORDERS:
        buckets, valid = part.grams(n, BITS)
        letters += np.where(valid[:, None], model.weights[buckets], 0)
    return part.per_word(letters)


def likelihoods(part: Slice, grams: np.ndarray) -> np.ndarray:
    """(words, languages): mean log probability of a word's n-grams."""
    size = part.end - part.start
    # As ``Slice.grams`` counts them: one at each letter from which on there are n - 2 or more.
    n = sum(np.maximum(size - max(order - 3, 0), 0) for order in ORDERS)
    return grams / np.maximum(n, 1)[:, None]


def explained(part: Slice, grams: np.ndarray, model: Model) -> np.ndarray:
    """Whether some language that uses a word's script has words like it."""
    fits = model.scripts[word_scripts(part)]
    if model.cutoffs is not None:
        fits = fits & (likelihoods(part, grams) >= model.cutoffs)
    return fits.any(1)


def word_scores(part: Slice, model: Model, grams: np.ndarray | None = None) -> np.ndarray:
    """(words, languages): mean log probability of a word's features, lowered outside its script."""
    sums = model.weights[part.words(BITS)] + (gram_scores(part, model) if grams is None else grams)
    allowed = model.scripts[word_scripts(part)]
    return np.where(allowed | ~allowed.any(1, keepdims=True), sums, sums - 50).astype(np.float32)


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word. Texts lie end to end, ``sizes`` words each."""
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    order = np.argsort(-sizes, kind="stable")
    begin, length = first[order], sizes[order]
    best = scores[begin].copy()
    back = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    own = np.arange(scores.shape[1])
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps), "left")  # texts with more than t words
    for t in range(1, steps):
        k = alive[t]
        now, at = best[:k], begin[:k] + t
        top = now.argmax(1)
        switch = now[np.arange(k), top] - penalty
        stay = now >= switch[:, None]
        back[at] = np.where(stay, own, top[:, None])
        best[:k] = np.where(stay, now, switch[:, None]) + scores[at]
    state = best.argmax(1)
    labels = np.zeros(len(scores), back.dtype)
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        labels[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return labels


def _groups(texts: list[str], limit: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def _label(texts: list[str], model: Model, penalty: float):
    """What ``label_spans`` gives, and per text the share of letters in words that a language explains."""
    best, share, spans, known = np.full(len(texts), -1), np.zeros(len(texts)), [[] for _ in texts], np.zeros(len(texts))
    if not model.languages:
        return best, share, spans, known
    for shift, group in _groups(texts):
        parts = []
        for p in slices(group):
            if len(p.start):
                grams = gram_scores(p, model)
                parts.append((word_scores(p, model, grams), p.doc, p.offset, p.end - p.start, explained(p, grams, model)))
        if not parts:
            continue
        scores, doc, offset, letters, fits = (np.concatenate(x) for x in zip(*parts))
        sizes = np.bincount(doc, minlength=len(group))
        some = np.flatnonzero(sizes)
        labels = viterbi(scores, sizes[some], penalty).astype(np.int64)
        count = np.zeros((len(group), len(model.languages)))
        np.add.at(count, (doc, labels), letters)
        best[shift + some] = count[some].argmax(1)
        share[shift + some] = count[some].max(1) / count[some].sum(1)
        known[shift + some] = np.bincount(doc, letters * fits, len(group))[some] / count[some].sum(1)
        edge = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
        last = np.append(edge[1:], len(doc)) - 1
        for d, k, a, b in zip(doc[edge], labels[edge], offset[edge], offset[last] + letters[last]):
            spans[shift + d].append((model.languages[k], int(a), int(b)))
    return best, share, spans, known


def label_spans(texts: list[str], model: Model, penalty: float):
    """Per text: best language index (-1 for none), its share of letters, spans (language, start, end)."""
    return _label(texts, model, penalty)[:3]


RESULT = "lang_pred string, score double, spans array<struct<lang:string,start:long,end:long>>"


def label(documents: DataFrame, model: Model, penalty: float = 8.0) -> DataFrame:
    """Columns ``doc_id``, ``lang_pred``, ``score`` and ``spans`` for every row of ``documents``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = np.array([*shared.value.languages, UNKNOWN], object)
        for batch in batches:
            best, share, spans = label_spans([t or "" for t in batch["text"]], shared.value, penalty)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names[best], "score": share, "spans": spans})

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInPandas(run, f"doc_id string, {RESULT}")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def keep(documents: DataFrame, model: Model, penalty: float = 8.0, least: float = LEAST, text: str = "text") -> DataFrame:
    """The documents of which learned languages explain at least ``EXPLAINED`` of the letters and one holds at
    least ``least``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                best, share, _, known = _label([t or "" for t in texts], shared.value, penalty)
                yield pd.Series((best >= 0) & (share >= least) & (known >= EXPLAINED))
        finally:
            release_memory()

    return documents.where(known(F.col(text).cast("string")))
