"""Lexical search, conversation repair and sharding against brute force and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import lexical, repair, sharding
from martloom.llm.queries import REGISTRY
from martloom.workspace import fresh_dir

SF = "/root/testdata/sf0.001"

# --- lexical search ---

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked(docs, items, k):
    held = [(d, collections.Counter(TERM.findall(lower(t)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    wanted = collections.defaultdict(set)
    for item, text in items:
        wanted[item] |= set(TERM.findall(lower(text)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n // length
            total = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                total += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if total > 0:
                scores.append((-total, d is None, d))
        for i, (score, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]):
            out.append((item, i + 1, d, -score))
    return sorted(out, key=str)


def found(spark, docs, items, **how):
    documents = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"n": F.lit(1), "terms": F.lit("x"), "score": F.lit(2), "item": F.lit(3), "rank": F.lit(4)}
    )
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    return sorted([tuple(r) for r in lexical.search(documents.repartition(3), asked, **how).collect()], key=str)


@pytest.mark.parametrize(("k", "chunk", "per_block"), [(3, 10**6, 2000), (10, 40, 2000), (2, 200, 3)])
def test_search_equals_brute_force(spark, k, chunk, per_block):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(30)] + ["Äpfel", "naïve", "漢字"]
    text = lambda n: " ".join(rng.choice(words[: rng.choice((5, 33))]) for _ in range(n))
    docs = [(i, text(rng.randrange(30))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(25)] + [(7, docs[7][1]), (None, docs[7][1]), (None, "w1"), (300, None), (301, ""), (302, "-- ."), (303, text(3000))]
    items = [(i, text(8)) for i in range(8)] + [(3, "W1-w2"), (None, "w3 w9"), (50, None), (51, "unseen"), (52, docs[7][1])]
    assert found(spark, docs, items, k=k, chunk=chunk, per_block=per_block) == ranked(docs, items, k)


def test_search_of_nothing(spark):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, None)], [(1, "a")]) == found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, "a")], [(1, None), (2, "b")]) == []


def test_search_passes_by_what_cannot_win(spark):
    words = [b"w%d" % i for i in range(50)]
    rng = random.Random(1)
    import numpy as np

    owner, rank, tf = [], [], []
    for d in range(2000):
        for r in sorted(rng.sample(range(50), 4 if d % 100 else 12)):
            owner.append(d)
            rank.append(r)
            tf.append(rng.randrange(1, 4))
    tree = lexical.Tree(
        np.array(owner), np.array(rank, np.int64), np.array(tf, np.int32), np.full(2000, 100), [(d, False) for d in range(2000)], 5
    )
    best = lexical.Best(5, None)
    tree.search(np.arange(3), np.array([9000, 8000, 7000]), best)
    assert len(words) == 50 and len(best.rows) == 5 and tree.visited < (tree.children > 0).sum() / 4


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Wörter und mehr " * 50).encode()
    whole = list(itertools.chain(*lexical.terms_of(text)))
    monkeypatch.setattr(lexical, "SLICE", 7)
    assert list(itertools.chain(*lexical.terms_of(text))) == whole == text.lower().split()


# --- conversation repair ---

PATTERN = re.compile(r"(s?(ua)+)?")


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, role, text


def audited(rows):
    """Faults, and the cheapest edits by trying all, of rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    seen, kinds = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    best = None
    ways = []
    for (_, role, text), kind in zip(rows, kinds):
        extra = int(kind == "truncated")
        own = [(3, "D", None)]
        if kind in ("", "truncated"):
            own += [(extra, "K", (role, text)), (2 + extra, "R", ("user", text)), (2 + extra, "R", ("assistant", text))]
        ways.append(own)
    for choice in itertools.product(*ways):
        # Inserts that make the rest fit: at most two in a row are ever needed.
        for spots in itertools.product(((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")), repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for i, spot in enumerate(spots):
                cost, audit, out = cost + 2 * len(spot), audit + "I" * len(spot), out + [(r, "") for r in spot]
                if i < len(rows):
                    c, e, o = choice[i]
                    cost, audit, out = cost + c, audit + e, out + ([o] if o else [])
            if (best is None or (cost, audit) < best[:2]) and PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in out)):
                best = cost, audit, "\n".join(f"{r}:{x}" for r, x in out)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = collections.Counter(kinds)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, best[0], hashlib.sha256(best[2].encode()).hexdigest(), best[1])


def streamed(spark, conversations, **how):
    rows = [(c, t, r, x, 1, 2) for c, turns in conversations.items() for t, r, x in turns]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, state int, h1 int")
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame, **how).collect()}


CONVERSATIONS = {
    1: [],
    2: [(0, "system", "Be short."), (1, "user", "Hi?"), (2, "assistant", "Hello.")],
    3: [(0, "user", "a."), (1, "user", "b"), (3, "assistant", "c.")],
    4: [(0, "assistant", "a."), (0, "assistant", "a."), (5, "user", "a.")],
    5: [(None, "user", "x"), (None, "user", "x"), (1, "user", "x"), (2, "tool", None)],
    6: [(1, None, "y."), (2, "", "z!"), (3, "system", "late.")],
    7: [(1, "user", " \t\n\x0b\x0c\r"), (1, "assistant", "q? \n")],
    8: [(1, "system", "s"), (2, "system", "t.")],
    None: [(1, "user", "null id."), (1, "assistant", "é")],
}


def test_repair_equals_trying_all_edits(spark):
    rng = random.Random(5)
    cases = {k: v for k, v in CONVERSATIONS.items() if v}
    for i in range(20):
        cases[100 + i] = [
            (rng.choice((None, 1, 2, 3, 7)), rng.choice(("system", "user", "user", "assistant", "assistant", "tool")), rng.choice(("a.", "b", "", "c!", "d")))
            for _ in range(rng.randrange(1, 4 if i else 5))
        ]
    assert streamed(spark, cases) == {k: audited(v) for k, v in cases.items()}


def test_spilled_backpointers_give_the_same_edits(spark):
    rng = random.Random(6)
    long = [(i, rng.choice(("system", "user", "assistant")), rng.choice(("a.", "b", " ")) + str(rng.randrange(500)) + ".") for i in range(1500)]
    cases = {1: long, None: long[:700], 2: long[:3], 3: [(0, "user", "x.")]}
    whole = streamed(spark, cases)
    assert streamed(spark, cases, spill_rows=64) == whole
    assert len(whole[1][-1].replace("I", "")) == 1500


def test_repair_of_dropped_rows_and_nothing(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b.")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in repair.repair(frame, F.col("conv_id") == 1).collect()}
    assert (got[1].cost, got[1].audit, got[1].gaps) == (0, "", 0) and got[1].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert (got[2].cost, got[2].audit) == (2, "KI") and got[2].repaired_sha256 == hashlib.sha256(b"user:b.\nassistant:").hexdigest()
    assert repair.repair(frame.limit(0)).collect() == []


def test_damage_of_nulls(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in (*range(40), None) for t in (0, None)] + [(3, 9, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("fault", F.lit(1))
    want = []
    for c, t, r, x in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        row = (c, t, "user" if f == 4 else r, "" if f == 1 else re.sub("[.!?]", "", x) if f == 2 else x, f == 0)
        want += [row] * (2 if f == 3 else 1)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in repair.damage(frame).collect())


# --- sharding ---


def sharded(rows, shards):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    total, before, out, filled = sum(s for _, s in rows), 0, [], collections.Counter()
    for key, size in rows:
        shard = min(shards - 1, (2 * before + size) * shards // max(2 * total, 2))
        out.append((key, size, shard, filled[shard]))
        filled[shard] += 1
        before += size
    return sorted(out, key=str)


@pytest.mark.parametrize("per_block", [1000, 17])
def test_shards_are_contiguous_and_even(spark, per_block):
    rng = random.Random(per_block)
    # A third of the rows share one key, one row is larger than a shard, null keys, repeated rows.
    rows = [(None if rng.random() < 0.1 else 5 if rng.random() < 0.4 else rng.randrange(400), rng.randrange(1, 50)) for _ in range(600)]
    rows += [(200, 5000), (201, 7), (201, 7)]
    frame = spark.createDataFrame(rows, "k long, size long").withColumns({"_at": F.lit(1), "_block": F.lit("x"), "n": F.lit(0)})
    got = sharding.assign(frame.repartition(5), 20, ["k", "size"], "size", per_block)
    assert got.columns == ["k", "size", "_at", "_block", "n", "shard", "slot"]
    assert sorted([(r.k, r["size"], r.shard, r.slot) for r in got.collect()], key=str) == sharded(rows, 20)


def test_shards_of_little(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k long, size long")
    assign = lambda rows: [tuple(r) for r in sharding.assign(frame(rows), 3, ["k"], "size").collect()]
    assert assign([]) == []
    assert assign([(1, None)]) == [(1, None, 0, 0)]
    assert assign([(1, 9)]) == [(1, 9, 1, 0)]
    with pytest.raises(Exception, match="negative size"):
        assign([(1, -1)])
    with pytest.raises(ValueError, match="shard or slot"):
        sharding.assign(frame([]).withColumn("Slot", F.lit(1)), 3, ["k"], "size")


def test_written_shards_are_read_back_in_order(spark):
    rows = [(i, 10 + i % 7, f"text {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "k long, size long, text string")
    path = fresh_dir(spark, "shards")
    sharding.write(sharding.assign(frame, 6, ["k"], "size", 50), path, "size", per_file=700)
    back = spark.read.parquet(path)
    assert sorted((r.k, r["size"], r.text) for r in back.collect()) == rows
    by_shard = back.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    total = sum(r[1] for r in rows)
    assert len(by_shard) == 6 and all(abs(r.b - total / 6) <= 17 and r.top == r.n - 1 for r in by_shard)


def test_queries_return_all_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = REGISTRY["op13_sharding"][0](spark, SF)
    assert got.count() == docs and got.where("grown_shard IS NOT NULL OR law <> 'bytes'").count() == 0
    convs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    assert REGISTRY["op12_repair"][0](spark, SF).count() == convs


# --- shingles and components of many at once ---


def test_shingle_sets_equal_those_of_single_texts(monkeypatch):
    import numpy as np

    from martloom.llm import shingles

    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdÉ") for _ in range(rng.randrange(12))) for _ in range(200)]
    texts += [None, "", " \n", "A b\tC", "x" * 300, "a a a a a a", "\x0bq\x0c", "word " * 100]
    for limit in (1 << 20, 64):
        monkeypatch.setattr(shingles, "SLICE", limit)
        for k in (1, 3, 5):
            elements, sizes = shingles.shingle_sets(texts, k)
            assert [x.tolist() for x in np.split(elements, np.cumsum(sizes)[:-1])] == [shingles.shingle_set(t, k).tolist() for t in texts]
        words, keys = shingles.word_sequences(texts)
        split = [tuple((t or "").encode().lower().split()) for t in texts]
        assert words.tolist() == [len(x) for x in split]
        assert len(set(keys.tolist())) == len(set(split)) and len(set(zip(keys.tolist(), split))) == len(set(split))
    assert [len(x) for x in shingles.shingle_sets([], 3)] == [0, 0]


@pytest.mark.parametrize("few", [0, 5, 1000])
def test_components_end_in_one_task_or_by_rounds(spark, monkeypatch, few):
    from martloom.llm import components as C

    monkeypatch.setattr(C, "FEW", few)
    rng = random.Random(few)
    pairs = [(i, i + 1) for i in range(100, 120)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    found, count = C.components(spark.createDataFrame(pairs, "a long, b long"), len(pairs))
    least = {x: x for p in pairs for x in p}
    while True:
        before = dict(least)
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    want = {x: m for x, m in least.items() if x != m}
    assert {r["node"]: r["component"] for r in found.collect()} == want and count == len(want)


# --- top-k beyond doubles ---


def test_topk_ranks_huge_components_and_empty_vectors(spark):
    from martloom.llm import topk

    rng = random.Random(2)
    big = [2.0**55, -(2.0**60), 2.0**1020, 3.5, -0.001, 2.0**53 + 2, 0.0]
    vectors = {i: [rng.choice(big) for _ in range(3)] for i in range(40)}
    vectors |= {50: [], 51: [], 52: [2.0**55, 0.0, 0.0], 53: [1.0], 54: [1.0, None, 2.0], 55: None, 56: [float("inf"), 0.0, 0.0]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    usable = {i: [topk.whole(x, 256) for x in v] for i, v in vectors.items() if v is not None and None not in v and float("inf") not in v}
    assert usable[52][0] == 2**63 and topk.whole(-0.001, 256) == -1
    want = []
    for q, x in usable.items():
        if q % 50 in (0, 2, 7):
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in usable.items() if i != q and len(y) == len(x))
            want += [(q, n + 1, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores[:5])]
    got = topk.top_k(frame, F.col("id").isin([q for q in usable if q % 50 in (0, 2, 7)]))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert (50, 1, 51, 0) in want
