"""Language, toxicity, quality rules, BPE and chat against brute force and edge cases."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from martloom.llm import bpe, chat, language, quality_rules, toxicity
from martloom.llm.common import text_crc
from martloom.llm.queries import REGISTRY
from martloom.llm.subwords import slices

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [None, "", " \n\t ", "x", "Ünï côdé", "word " * 30_000, "a" * 3000, "the cat\nthe cat\n", "漢字 かな", "1 2 3 #$%"]


def edge_docs(spark, more=()):
    rows = [(i, t, "en", None, None) for i, t in enumerate(EDGES)] + [(3, "x", None, "s", 1), (None, "null id", None, None, None)]
    return spark.createDataFrame([*rows, *more], DOCS)


def clashing(docs):
    """Extra columns named as the operators' own results and helpers."""
    names = ("score", "lang_pred", "_quality", "kept", "_words", "label", "id", "bin_id", "spans", "_gone", "component_id")
    return docs.select("*", *[F.lit(1).alias(n) for n in names])


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- subwords ---


def test_subwords_are_words_with_boundaries():
    text = "Ab c1d\n ÉÉ 漢字"
    (part,) = slices([text, None or "", "zz"])
    words = ["".join(map(chr, part.codes[a:b])) for a, b in zip(part.start, part.end)]
    assert words == ["ab", "c", "d", "éé", "漢字", "zz"]
    assert [text[o : o + len(w)].lower() for o, w in zip(part.offset[:5], words)] == words[:5]
    assert list(part.doc) == [0, 0, 0, 0, 0, 2]
    # Equal words hash alike, others don't; a word of two letters has two trigrams, one of one has one.
    (other,) = slices(["c ab"])
    assert other.words(20)[1] == part.words(20)[0] and other.words(20)[0] == part.words(20)[1]
    assert list(part.per_word(part.grams(3, 20)[1].astype(int)))[:3] == [2, 1, 1]
    assert list(part.per_word(part.grams(4, 20)[1].astype(int)))[:3] == [1, 0, 0]


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr("martloom.llm.subwords.SLICE", 50)
    text = "alpha beta " * 40
    parts = list(slices([text, "end"]))
    words = [(int(d), int(o)) for p in parts for d, o in zip(p.doc, p.offset)]
    assert words == [(0, m.start()) for m in re.finditer(r"\w+", text)] + [(1, 0)]


# --- language ---


def test_language_held_out_accuracy(spark):
    rows = REGISTRY["op7_language"][0](spark, "/root/testdata/sf0.01").collect()
    real = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(real)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == real[r.doc_id] for r in held) / len(held) > 0.97


def brute_viterbi(scores, penalty):
    best = [(s, [k]) for k, s in enumerate(scores[0])]
    for row in scores[1:]:
        best = [max(((v - (0 if p[-1] == k else penalty) + s, [*p, k]) for v, p in best), key=lambda x: x[0]) for k, s in enumerate(row)]
    return max(best, key=lambda x: x[0])[1]


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    sizes = np.array([5, 1, 9, 3, 9])
    scores = rng.normal(0, 2, (sizes.sum(), 3))
    found = language.viterbi(scores, sizes, 1.5)
    begin = 0
    for n in sizes:
        assert list(found[begin : begin + n]) == brute_viterbi(scores[begin : begin + n], 1.5)
        begin += n


def test_spans_of_mixed_text_and_scripts(spark):
    rows = [(i, t, k, None, None) for i, (t, k) in enumerate([("the cat sat on the mat " * 9, "en"), ("кот сидел на ковре " * 9, "ru")] * 4)]
    model = language.fit(spark.createDataFrame(rows, DOCS), F.lit(True))
    text = "the cat sat on the mat. кот сидел на ковре"
    best, share, spans = language.label_spans([text, "123", "漢字"], model, 8.0)
    assert [(k, text[a:b]) for k, a, b in spans[0]] == [("en", "the cat sat on the mat"), ("ru", "кот сидел на ковре")]
    assert model.languages[best[0]] == "en" and 0.5 < share[0] < 0.6
    assert best[1] == -1 and share[1] == 0 and best[2] >= 0


def test_language_stage_rejects_what_no_language_explains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    model = language.fit(docs, text_crc("doc_id") % 4 != 2)
    rng = np.random.default_rng(3)
    own = [r.text for r in docs.orderBy("doc_id").limit(4).collect()]
    foreign = ["все люди рождаются свободными и равными в своем достоинстве " * 5, "人人生而自由 在尊严和权利上一律平等 " * 5,
               " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 6)) for _ in range(60)),
               "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw"]
    half = own[1][:400] + " " + foreign[0][:200]
    rows = [(i, t, None, None, None) for i, t in enumerate([*own, half, *foreign, foreign[1] + own[1][:20]])]
    best, share, _ = language.label_spans([r[1] for r in rows], model, 8.0)
    assert (best >= 0).all() and (share >= language.LEAST).all()  # labels and their shares don't tell
    assert {r.doc_id for r in language.keep(spark.createDataFrame(rows, DOCS), model).collect()} == {0, 1, 2, 3, 4}
    assert language.keep(docs, model).count() == docs.count()


def test_language_edges(spark):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    model = language.fit(docs, text_crc("doc_id") % 4 != 2)
    found = language.label(clashing(edge_docs(spark)), model).collect()
    assert len(found) == len(EDGES) + 2
    by = collections.defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (0, 1, 2, 9))
    assert by[5][0].lang_pred in model.languages and 0 < by[5][0].score <= 1
    assert by[3][0].lang_pred == by[3][1].lang_pred
    assert language.label(docs.limit(0), model).count() == 0
    nothing = language.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language.label(docs.limit(5), nothing).collect()} == {"und"}
    kept = language.keep(clashing(edge_docs(spark)), model)
    assert kept.columns == clashing(edge_docs(spark)).columns and kept.where("text IS NULL OR text = ''").count() == 0


# --- toxicity ---


def test_toxicity_shares_vectors_with_misspellings():
    rng = np.random.default_rng(3)
    clean = ["".join(rng.choice(list("aeiourstln"), 5)) for _ in range(400)]
    texts, labels = [], []
    for i in range(400):
        words = list(rng.choice(clean, 40))
        if i % 4 == 0:
            words[int(rng.integers(40))] = rng.choice(["scumbag", "zombiehead", "wormface"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = toxicity.train(texts, np.array(labels), np.ones(400))
    scores = toxicity.score_texts([*texts, "aeriou scumbagg touns", "lotus zombieheed", "aeros tunes " * 200, "", "12"], model)
    assert ((scores[:400] >= 0.5) == np.array(labels)).mean() > 0.99
    assert scores[400] > 0.5 and scores[401] > 0.5 and scores[402] < 0.5
    assert scores[403] == scores[404] == 0.25


def test_toxicity_query_and_edges(spark):
    rows = REGISTRY["op1_toxicity"][0](spark, SF).collect()
    assert len(rows) == documents(spark).count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(documents(spark), labels, F.lit(True))
    found = toxicity.score(clashing(edge_docs(spark)), model).collect()
    assert len(found) == len(EDGES) + 2 and all(0 <= r.score <= 1 for r in found)
    none = toxicity.fit(documents(spark), labels.limit(0), F.lit(True))
    assert all(r.score < 1e-9 for r in toxicity.score(documents(spark).limit(9), none).collect())
    assert toxicity.score(documents(spark).limit(0), model).count() == 0


# --- quality rules ---


def features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(spark):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        edge_docs(spark).withColumn("doc_id", F.col("doc_id") + 10_000)
    )
    found = quality_rules.report(clashing(docs), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    assert len(found) == docs.count()
    for r in found:
        n, chars, symbols, lines, repeats = features(texts[r.doc_id][0])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (r.base_failed and r.kept)


def test_binomial_tail_is_exact(spark):
    cases = [(0, 50), (1, 50), (3, 400), (30, 4000), (40, 4000), (7, 100_000), (5, 100)]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.withColumn("p", quality_rules.binomial_log_cdf(F.col("k"), F.col("n"), 0.01)).collect():
        if r.k >= r.n * 0.01:
            assert r.p == 0
            continue
        terms = [
            math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1) + j * math.log(0.01) + (r.n - j) * math.log(0.99)
            for j in range(r.k + 1)
        ]
        top = max(terms)
        assert r.p == pytest.approx(top + math.log(sum(math.exp(t - top) for t in terms)), rel=1e-9)


def log_cdf(k, n, p):
    if k >= n * p:
        return 0.0
    terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p) for j in range(k + 1)]
    return max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))


def test_cutoffs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rates = quality_rules.RATES
    rows = []
    for i in range(6000):
        good = bool(rng.random() < 0.8)
        stratum = "a" if i % 3 else ("b" if i % 2 else "few" if i < 60 else "some" if i < 1500 else "a")
        rows.append((stratum, good, tuple(float(x) for x in rng.beta(*((0.3, 40) if good else (2, 3)), len(rates)))))
    schema = "stratum string, good boolean, f struct<" + ",".join(f"{r}:double" for r in rates) + ">"
    found = {r.stratum: r.cutoffs for r in quality_rules.risk_cutoffs(spark.createDataFrame(rows, schema), "stratum", "good", "f").collect()}
    strata = {r[0] for r in rows}
    tested = {}
    for s in strata:
        n = sum(r[0] == s and r[1] for r in rows)
        limit = lambda m: math.log(0.05 / (m * len(strata)))
        m = tested[s] = max((m for m in range(1, 5) if n * math.log(1 - 0.04 / m) <= limit(m)), default=0)
        for j, rate in enumerate(rates):
            if j >= m:
                assert rate not in found.get(s, {})
                continue
            good = [r[2][j] for r in rows if r[0] == s and r[1]]
            bad = [r[2][j] for r in rows if r[0] == s and not r[1]]
            best = (0, None)
            for c in quality_rules.GRID:
                k = sum(x > c for x in good)
                if log_cdf(k, len(good), 0.04 / m) > limit(m):
                    break
                gain = sum(x > c for x in bad) - k
                if gain > best[0]:
                    best = (gain, c)
            assert found.get(s, {}).get(rate) == best[1]
    assert "few" not in found and len(found["a"]) == 4
    assert tested["few"] == 0 < tested["some"] < tested["b"] == 4 and found["some"]


def test_learned_cutoffs_reject_and_keep_their_promise(spark):
    """On given tables some cutoffs are certified, and of good documents few go by them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality_rules.report(docs, labels).where("NOT base_failed").join(labels.select("doc_id", "quality"), "doc_id", "left")
    learned = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    good, lost, caught = learned[1, True], learned.get((1, False), 0), learned.get((0, False), 0)
    assert caught > 10 and lost <= 0.04 * (good + lost)


def test_quality_keeps_columns_and_empty_tables(spark):
    docs = clashing(edge_docs(spark))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality_rules.keep(docs, labels)
    assert kept.columns == docs.columns
    # Only the long and the null-free texts of ten words pass the base rule; the long one repeats itself.
    assert kept.count() == 0
    assert quality_rules.report(docs.limit(0), labels).count() == 0
    fine = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)), None, None, None)], DOCS)
    assert quality_rules.keep(fine, labels.limit(0)).count() == 1


# --- BPE ---


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_bpe_equals_tiktoken_and_round_trips(spark, ranks):
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["<|endoftext|> it's", "=" * 2000 + " " * 500 + "x", " \n" * 100, "😀" * 300, "a\x85b\xa0c\u3000d"]
    docs = edge_docs(spark, [(100 + i, t, None, None, None) for i, t in enumerate(odd)])
    rows = bpe.encode(clashing(docs).withColumnRenamed("id", "_id2"), ranks, public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = rows.collect()
    assert len(found) == docs.count()
    assert all(r.ids == ref.encode_ordinary(texts[r.doc_id]) for r in found)
    assert all(bytes(r.data).decode() == texts[r.doc_id] for r in bpe.decode(rows, ranks, public_tokenizers.PATTERN).collect())
    for r in bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).collect():
        ids = ref.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_bpe_query_over_all_texts(spark, ranks):
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    found = REGISTRY["op3_bpe"][0](spark, SF).collect()
    assert len(found) == len(texts)
    assert all(r.n_tokens == len(ref.encode_ordinary(texts[r.doc_id])) for r in found)


def test_long_words_contract_in_the_same_order(ranks, monkeypatch):
    coder = bpe.Coder(ranks, bpe.merge_pairs(ranks), public_tokenizers.PATTERN)
    words = ["abababab" * 9, "aaaaaaa", "thethethe", "ééàà", "zqxjkv" * 20]
    coder.learn(set(words))
    for w in words:
        data = w.encode()
        ids = [ranks[data]] if data in ranks else bpe.contract_long(data, ranks)
        assert coder.memory[w][0] == " ".join(map(str, ids))


def test_text_pieces_split_alike(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    coder = bpe.Coder(ranks, bpe.merge_pairs(ranks), public_tokenizers.PATTERN)
    for text in ("a bc   def\n\n ghi's  x", "nospaceatallinthistext", "   ", "", "x  \n y"):
        assert sum(coder.words(text), []) == coder.split.findall(text)


def test_bpe_many_long_words_in_one_text(ranks, monkeypatch):
    coder = bpe.Coder(ranks, bpe.merge_pairs(ranks), public_tokenizers.PATTERN)
    exact = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdefgh\u00e9\u6f22", k=k)) for k in (50, 100, 120) for _ in range(1200)]
    text = " ".join([*words, "x" * 256, "ab" * 700])
    begun = time.perf_counter()
    ids = bpe.ids_of(next(coder.encode([text])))
    assert time.perf_counter() - begun < 60
    assert ids.tolist() == exact.encode_ordinary(text)
    monkeypatch.setattr(bpe, "DECODE_IDS", 1000)  # one text over many rounds, and empty ones between
    assert coder.decode([ids[:0], ids, ids[:3], ids[:0]]) == [b"", text.encode(), exact.decode_bytes(ids[:3].tolist()), b""]
    with pytest.raises(ValueError):
        coder.decode([np.array([len(ranks) + 7])])


# --- chat ---


def test_chat_escapes_reversibly():
    for text in ("", "\\", "\\\\<turn>", "<turn></turn>\n", "### A\\### <image:0>", "\\n<document:", "plain"):
        assert chat.unescape(chat.escape(text)) == text
        assert not any(re.search(r"(?<!\\)(\\\\)*" + re.escape(c), chat.escape(text)) and c in text and c not in chat.escape(text) for c in chat.CONTROLS)
    assert "<turn>" not in chat.escape("<turn>").replace("\\<turn>", "")


def test_chat_parts_become_placeholders(spark):
    part = "struct<kind:string,text:string,ref:string,amount:double>"
    rows = [
        (1, 0, "user", [("text", "see <image:0>", None, None), ("image", None, "s3://a.png", 1.0), ("audio", None, "b.wav", 2.0)]),
        (1, 1, "assistant", [("text", "ok", None, None), None, ("odd", "kept", None, None)]),
        (1, 2, "user", [("document", None, "c.pdf", 3.0), ("image", None, "d.png", None)]),
        (1, 3, "user", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{part}>")
    found = chat.format_turns(df, text=None, content="content").orderBy("position").collect()
    assert found[0].formatted == "<turn>user\nsee \\<image:0><image:0><audio:1></turn>\n"
    assert [tuple(a) for r in found for a in r.attachments] == [
        (0, "image", "s3://a.png", 5103), (1, "audio", "b.wav", 50), (2, "document", "c.pdf", 2100), (3, "image", "d.png", 1),
    ]
    whole = "".join(r.formatted for r in found)
    assert whole[found[1].loss_start : found[1].loss_end] == "okkept"
    assert chat.read_back(chat.format_turns(df, text=None, content="content")).first().attachment_tokens == 5103 + 50 + 2100 + 1


def test_chat_edges_equal_brute_force(spark):
    rows = [
        (1, 1, "assistant", "b\\<turn>"), (1, 0, "user", None), (1, 1, "assistant", "a"), (1, None, "us\ner", "first"),
        (None, 0, "assistant", "null conv"), (2, 0, None, ""), (2, 1, "assistant", "x" * 50_000), (2, 1, "assistant", "x" * 50_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"formatted": F.lit(1), "position": F.lit(2)})
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((-1 if turn is None else turn, role or "", text or ""))
    for ordered in (True, False):
        found = chat.read_back(chat.format_turns(df), ordered=ordered).collect()
        assert len(found) == len(by)
        for r in found:
            turns = sorted(by[r.conv_id])
            loss = "".join(t for _, role, t in turns if role == "assistant")
            assert r.n_turns == len(turns) and r.loss_chars == len(loss)
            assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
            assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0
