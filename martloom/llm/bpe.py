"""Byte-level BPE: recursive queries of an embedded engine within each partition.

A text is split by a pattern into words. Within a task the distinct words of a group of texts become
token-position rows, a byte per row, each with the rank of the pair that it begins. A recursive query contracts
each word's leftmost pair of the smallest rank, joins the rows that this touched to their neighbours and to the
merge table, and repeats until no word has a pair left. Texts are put together from their words in order, and
their ids are decoded by ordered aggregation. The engine runs in the task's own process, in memory, on one thread.

The merge table lists, for every token, the pairs of tokens that concatenate to it; the pair's rank
is the token's own. A word that is a token itself is that token. Words longer than ``LONG`` bytes, for
which contracting one pair per round is quadratic (200 of 1000 letters take 13 s so, and 0.6 s from a heap; 20,000
of 100 letters 18 s), are contracted in the same order from a heap.

Ranks and pattern are parameters; the ranks' size is fixed by the vocabulary and they go to the tasks as a
broadcast. Words already seen are kept from group to group, up to ``MEMORY`` of them.

Defined results: null text is empty and has no ids; every text is encoded as ordinary text, without
special tokens; repeated rows are encoded alike; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import groups

LONG = 256
GROUP_CHARS, PIECE_CHARS, MEMORY = 4 << 20, 1 << 20, 800_000
ROUND_BYTES, DECODE_IDS = 1 << 17, 1 << 19

# A row knows the place of its token (word and position in one number), the place after it, and of the pair with
# the token after it the rank and position in one number and the place after the pair. Each round: the best pair per
# word, its two rows contracted, and the pairs of the contracted row and of the one before it looked up anew:
# first the neighbour, by its place, then both ids in the merge table. Rows of words without a pair are done
# and leave the recursion.
CONTRACT = """
WITH RECURSIVE rows(word, place, after, id, pair, stop, done) AS (
  SELECT a.word, a.place, a.place + 1, a.id, m.id::BIGINT << 32 | (a.place & 4294967295), CASE WHEN m.id IS NOT NULL THEN a.place + 2 END, false
  FROM tokens a LEFT JOIN tokens b ON b.place = a.place + 1 LEFT JOIN merges m ON m.both = a.id::BIGINT << 32 | b.id
  UNION ALL (
    WITH best AS (
      SELECT word, min(pair) AS pair, arg_min(place, pair) AS place, arg_min(after, pair) AS gone, arg_min(stop, pair) AS stop
      FROM rows WHERE NOT done GROUP BY word
    ), kept AS (
      SELECT r.word, r.place, CASE WHEN r.place = b.place THEN b.stop ELSE r.after END AS after,
        CASE WHEN r.place = b.place THEN (b.pair >> 32)::INT ELSE r.id END AS id, r.pair, r.stop,
        b.pair IS NULL AS done, b.pair IS NOT NULL AND (r.place = b.place OR r.after = b.place) AS stale
      FROM rows r JOIN best b ON r.word = b.word
      WHERE NOT r.done AND (b.pair IS NULL OR r.place <> b.gone)
    )
    SELECT word, place, after, id, pair, stop, done FROM kept WHERE NOT stale
    UNION ALL
    SELECT a.word, a.place, a.after, a.id, m.id::BIGINT << 32 | (a.place & 4294967295), CASE WHEN m.id IS NOT NULL THEN b.after END, false
    FROM (SELECT * FROM kept WHERE stale) a LEFT JOIN kept b ON b.place = a.after LEFT JOIN merges m ON m.both = a.id::BIGINT << 32 | b.id
  )
)
SELECT word, id FROM rows WHERE done ORDER BY place
"""

DECODE = "SELECT row, string_agg(hex, '' ORDER BY pos) AS bytes FROM given JOIN vocabulary USING (id) GROUP BY row ORDER BY row"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Rows (left id, right id, id of both together)."""
    rows = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rows.append((left, right, rank))
    return np.array(rows, np.int32).reshape(-1, 3)


def contract_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Leftmost pair of the smallest rank first, as in ``CONTRACT``, by a heap over linked parts."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n:
            rank = ranks.get(word[a : end[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

    for a in range(n):
        offer(a)
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if not alive[a] or end[a] != b or not alive[b] or end[b] != stop:
            continue
        alive[b] = False
        end[a] = stop
        if stop < n:
            before[stop] = a
        if before[a] >= 0:
            offer(before[a])
        offer(a)
    return [ranks[word[a : end[a]]] for a in range(n) if alive[a]]


@dataclass
class Coder:
    """One task's engine; what it keeps of a word is its ids as text and as 32-bit numbers."""

    ranks: dict[bytes, int]
    merges: np.ndarray
    pattern: str
    memory: dict[str, tuple[str, bytes]] = field(default_factory=dict)

    def __post_init__(self):
        self.split = regex.compile(self.pattern)
        self.engine = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.byte_id = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        left, right, whole = self.merges.T
        self.fill("merges", {"both": left.astype(np.int64) << 32 | right, "id": whole})
        ids = np.array(list(self.token), np.int32)
        self.known = np.zeros(ids.max(initial=0) + 1, bool)
        self.known[ids] = True
        self.fill("vocabulary", {"id": ids, "hex": [t.hex() for t in self.token.values()]})

    def fill(self, name: str, columns: dict) -> None:
        given = pa.table(columns)
        self.engine.register("given_rows", given)
        self.engine.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given_rows")
        self.engine.unregister("given_rows")

    def learn(self, words: set[str]) -> None:
        """Put all words into memory; a full memory keeps only those of them that it has."""
        if len(self.memory) > MEMORY:
            kept = {w: self.memory[w] for w in words if w in self.memory}
            self.memory.clear()
            self.memory.update(kept)
        todo, raw = [], []
        for word in words:
            if word in self.memory:
                continue
            data = word.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.keep([word], np.array([rank], np.int32), [1])
            elif len(data) > LONG:
                ids = contract_long(data, self.ranks)
                self.keep([word], np.array(ids, np.int32), [len(ids)])
            else:
                todo.append(word)
                raw.append(data)
        # Words of like lengths together: a round costs as many rows as words in it are not done.
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        todo, raw = [todo[i] for i in order], [raw[i] for i in order]
        for a, b in groups([len(x) for x in raw], ROUND_BYTES):
            names, part = todo[a:b], raw[a:b]
            size = np.array([len(x) for x in part])
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            codes = np.frombuffer(b"".join(part), np.uint8)
            word = np.repeat(np.arange(len(part), dtype=np.int32), size)
            self.fill("tokens", {"word": word, "place": word.astype(np.int64) << 32 | place, "id": self.byte_id[codes]})
            found = self.engine.execute(CONTRACT).fetchnumpy()
            ends = np.cumsum(np.bincount(found["word"], minlength=len(part)))
            self.keep(names, np.asarray(found["id"], np.int32), ends.tolist())

    def keep(self, words: list[str], ids: np.ndarray, ends: list[int]) -> None:
        """Remember words, whose ids lie one after the other up to ``ends``."""
        texts, data, a = list(map(str, ids.tolist())), ids.tobytes(), 0
        for word, b in zip(words, ends):
            self.memory[word] = (" ".join(texts[a:b]), data[4 * a : 4 * b])
            a = b

    def words(self, text: str) -> Iterator[list[str]]:
        """Words of a text, piece by piece. A word never runs from other text into white space, so
        a cut there changes none."""
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE_CHARS)
            while end < len(text) and not (text[end] == " " and not text[end - 1].isspace()):
                end += 1
            yield self.split.findall(text, at, end) if end - at < len(text) else self.split.findall(text)
            at = end

    def encode(self, texts: list[str]) -> Iterator[list[tuple[str, bytes]]]:
        """Per text what is kept of its words, in order. Only one text's words are held at a time."""
        for a, b in groups([len(t) for t in texts], GROUP_CHARS):
            seen: set[str] = set()
            lists = []
            for text in texts[a:b]:
                parts = []
                for part in self.words(text):
                    seen.update(part)
                    parts.append(part)
                lists.append(parts)
            self.learn(seen)
            for parts in lists:
                yield [self.memory[w] for part in parts for w in part]

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """Bytes of lists of ids, by ordered aggregation of a bounded number of them at a time; an id
        outside the vocabulary is an error."""
        pieces = [(i, np.asarray(r[a : a + DECODE_IDS], np.int32)) for i, r in enumerate(rows) for a in range(0, len(r), DECODE_IDS)]
        out: list[list[bytes]] = [[] for _ in rows]
        for a, b in groups([len(ids) for _, ids in pieces], DECODE_IDS):
            part = [ids for _, ids in pieces[a:b]]
            ids = np.concatenate(part)
            if ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all():
                raise ValueError("an id is not in the vocabulary")
            piece = np.repeat(np.arange(len(part), dtype=np.int32), [len(x) for x in part])
            self.fill("given", {"row": piece, "pos": np.arange(len(ids), dtype=np.int32), "id": ids})
            for i, data in self.engine.execute(DECODE).fetchall():
                out[pieces[a + i][0]].append(bytes.fromhex(data))
        return [b"".join(x) for x in out]


def ids_of(kept: list[tuple[str, bytes]]) -> np.ndarray:
    """Ids of a text from what is kept of its words."""
    return np.frombuffer(b"".join([x[1] for x in kept]), np.int32)


_CODERS: dict[str, Coder] = {}


def coder_of(shared) -> Coder:
    """The coder of this worker process, which its next tasks use again."""
    name, ranks, merges, pattern = shared.value
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Coder(ranks, merges, pattern)
    return _CODERS[name]


def _share(df: DataFrame, ranks: dict[bytes, int], pattern: str):
    """Ranks, merge table and pattern under a name that their content gives."""
    merges = merge_pairs(ranks)
    name = hashlib.sha256(b"".join(sorted(ranks, key=ranks.get)) + merges.tobytes() + pattern.encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((name, ranks, merges, pattern))


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row."""
    shared = _share(documents, ranks, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = coder_of(shared)
        for batch in batches:
            found = coder.encode([t or "" for t in batch["text"]])
            ids = [ids_of(kept) for kept in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids})

    return _rows(documents, doc_id, text).mapInPandas(run, "doc_id string, ids array<int>").withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )


def decode(encoded: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id`` and ``data`` (bytes) of every row of ``encoded``; null ids are no bytes."""
    shared = _share(encoded, ranks, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = coder_of(shared)
        for batch in batches:
            ids = [() if x is None else x for x in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "data": coder.decode(ids)})

    rows = encoded.select(F.col("doc_id").cast("string").alias("doc_id"), "ids")
    return rows.mapInPandas(run, "doc_id string, data binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def round_trip(documents: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and digest of every row's ids, and digest of what these ids decode to; neither the ids nor
    the bytes leave the task."""
    shared = _share(documents, ranks, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = coder_of(shared)
        for batch in batches:
            digests, decoded, waiting, size = [], [], [], 0
            for kept in coder.encode([t or "" for t in batch["text"]]):
                ids = ids_of(kept)
                digests.append((len(ids), hashlib.sha256(" ".join([x[0] for x in kept]).encode()).hexdigest()))
                waiting.append(ids)
                size += len(ids)
                if size >= DECODE_IDS:
                    decoded += [hashlib.sha256(x).hexdigest() for x in coder.decode(waiting)]
                    waiting, size = [], 0
            decoded += [hashlib.sha256(x).hexdigest() for x in coder.decode(waiting)]
            frame = pd.DataFrame(digests, columns=["n_tokens", "ids_sha256"]).assign(decoded_sha256=decoded)
            yield frame.assign(doc_id=list(batch["doc_id"]))[["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]]

    found = _rows(documents, doc_id, text).mapInPandas(
        run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
