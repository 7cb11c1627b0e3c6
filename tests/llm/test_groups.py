"""Candidate groups of the similarity join, and what is moved for them."""

import random

import numpy as np
import pytest

from martloom.llm import ngram_join
from martloom.llm.shingles import shingle_set


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sketches_of_any_width_are_lower_bounds(percent):
    """F1, F2"""
    rng = np.random.default_rng(3)
    whole = rng.integers(0, 2**63, 9000).astype(np.uint64)
    sets = [np.unique(rng.choice(whole[: 3 * n], n)) for n in (1, 2, 7, 30, 90, 110, 700, 850, 6000)]
    sizes = np.array([len(s) for s in sets])
    words = ngram_join.sketch_words(percent, sizes)
    assert (np.bitwise_count(words.astype(np.uint64)) == 1).all() and words.max() <= 64
    cuts = np.split(ngram_join.parities(np.concatenate(sets), sizes, percent), np.cumsum(words)[:-1])
    for i, a in enumerate(cuts):
        for j, b in enumerate(cuts[:i]):
            while len(a) != len(b):
                a, b = sorted((a, b), key=len)
                b = b[: len(b) // 2] ^ b[len(b) // 2 :]
            assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(sets[i], sets[j]))
            a = cuts[i]
    for size, sketch in zip(sizes, cuts):  # nothing tells equal sets apart
        assert ngram_join.close_links(np.arange(2), np.array([size] * 2), [sketch.tobytes()] * 2, np.zeros(2), False, percent) == [(0, 1)]
    far = [x.tobytes() for x in cuts[5:7]]
    assert ngram_join.close_links(np.arange(2), sizes[5:7], far, np.zeros(2), False, percent) == []


def boilerplate(n):
    """Texts of which most is common to all, so that chance joins the rest; three copies of one but for a word."""
    rng = random.Random(5)
    shared = [f"c{j}" for j in range(64)]
    own = [[f"u{rng.randrange(10**9)}" for _ in range(49)] for _ in range(n)]
    rows = [(i, " ".join(shared + words)) for i, words in enumerate(own)]
    return rows + [(n + i, rows[7][1] + f" z{i}") for i in range(3)]


def test_chance_groups_move_no_sets(spark, monkeypatch):
    """whole sets went to every pair of blocks of a group that chance had joined."""
    rows, staged = boilerplate(400), {}
    stage = ngram_join.stage

    def logged(df, label):
        out = stage(df, label)
        staged[label] = [tuple(r) for r in out.select("id", "grp").collect()] if label == "live" else out.count()
        return out

    monkeypatch.setattr(ngram_join, "stage", logged)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
    found = {r.id: r.component_id for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()}
    assert found == {i: 7 if i >= 400 else i for i in range(403)}
    groups = [g for _, g in staged["live"]]
    assert max(map(groups.count, set(groups))) > 100  # a large group of texts with little in common
    assert staged["units"] <= 8


def test_many_passes_and_blocks_equal_one(spark, monkeypatch):
    """``units`` of more rows than are sent at once had all texts shuffled to them."""
    rng = random.Random(8)
    base = [f"w{j}" for j in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99999)}"
        rows.append((i, " ".join(words[: rng.randrange(90, 121)])))
    rows += [(3, rows[3][1]), (None, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lambda: sorted(tuple(-1 if x is None else x for x in (r.id, r.component_id)) for r in ngram_join.link(docs, 3, 90).collect())
    one = found()
    for name, value in (("BLOCK_DOCS", 16), ("NEAR_DOCS", 32), ("SENT", 100)):
        monkeypatch.setattr(ngram_join, name, value)
    assert found() == one
    sets = [shingle_set(t, 3) for _, t in rows]
    similar = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b))
    label = list(range(160))
    for i in range(160):
        for j in range(i):
            if label[i] != label[j] and similar(sets[i], sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    assert {i: c for i, c in one if i >= 0} == dict(enumerate(label))
