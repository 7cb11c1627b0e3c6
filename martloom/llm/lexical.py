"""Exact ranked lexical search of items over documents by a document FP-tree.

A document's vector is restricted to the terms that items use, with its counts (tf) and the length term
``m``. Vectors are ordered by document frequency, the rarest term first, and documents whose ordered vectors
begin alike share a path of a trie (paths without a branch are one node). With the most frequent term first, 30,000
documents made tries of 122 levels instead of 16, of which 200 items visited 400,000 nodes instead of 229,000. Every node has the largest tf of each
term below it, the smallest ``m`` and the smallest id. As a term's part of the score grows with tf and falls
with ``m``, these bound the score of all documents below. Each item walks the trie depth first, the child of the
highest bound first, and passes by all nodes whose bound can't enter its best ``k`` so far; a leaf's bound is its
score. Documents with equal vectors and lengths are one leaf, of which the ``k`` smallest ids count.

Three passes: texts become written vectors, which no later pass reads texts again for; vectors give the document
frequencies, the number of documents and their length; each task builds tries over ``CHUNK`` entries of its
documents at a time and carries the items' best from trie to trie, so rows of documents are never shuffled and a
task returns at most ``k`` rows an item. A first search over a bounded sample of the vectors gives
each item a score that its ``k``-th best can't fall below, so tasks don't start from nothing.

Items are taken in blocks of bounded number and text, each block a search of its own, so what tasks hold of
them has a size that doesn't depend on their number.

Defined results: null and empty texts have no term; documents without a term aren't counted; rows that share a
document id are each ranked; a null id comes after all others at the same score; rows that share an item id
are one item with the terms of all; an item without a term, or an empty table, gives no rows; further
columns are ignored. All but the weight is in 64-bit integers.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .common import partitions_for

# What a term is, in UTF-8 bytes, and the score's constants.
TERM, BETWEEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")
SCALE, LENGTH_SHARE = 1_000_000_000, 90
CHUNK = 1_000_000  # (document, term) entries of a trie
LEAVES = 16  # nodes of so many leaves aren't branched further
ITEMS, ITEM_BYTES = 2000, 8 << 20  # of a block of items
SAMPLE_DOCS = 20_000
SLICE = 4 << 20  # bytes of a text whose terms are listed at once


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Lists of a text's terms in order; long texts give several."""
    text = text.lower()
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        yield TERM.findall(text, at, end)
        at = end


VECTORS = "doc_id long, n long, terms binary, tfs binary"


def _vectors(words: list[bytes]):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(words)}
        for batch in batches:
            ids, lengths, terms, tfs = [], [], [], []
            for doc, text in zip(batch.column(0), batch.column(1)):
                total, counts = 0, Counter()
                for found in terms_of(text.as_buffer().to_pybytes() if text.is_valid else b""):
                    total += len(found)
                    counts.update(filter(number.__contains__, found))
                if total:
                    ids.append(doc.as_py())
                    lengths.append(total)
                    terms.append(np.array([number[w] for w in counts], np.int32).tobytes())
                    tfs.append(np.array(list(counts.values()), np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, lengths, terms, tfs), schema)], schema=schema)

    return run


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at])], ["term", "df"])

    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Best:
    """The best ``k`` (score, id) of an item; ``floor`` is one that they can't fall below."""

    def __init__(self, k: int, floor: tuple | None):
        self.k, self.limit, self.rows = k, floor, []

    def open(self, score: int, doc: int) -> bool:
        return score > 0 and (self.limit is None or (-score, doc) <= self.limit[:2])

    def offer(self, score: int, doc: tuple[int, bool]) -> bool:
        key = (-score, *doc)
        if score <= 0 or self.limit is not None and key > self.limit:
            return False
        insort(self.rows, key)
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.limit = self.rows[-1] if self.limit is None else min(self.limit, self.rows[-1])
        return True


class Tree:
    """Trie over documents' vectors of (rank, tf), with bounds per node.

    ``owner``, ``rank`` and ``tf`` are the entries, by owner and rank; ``m`` and ``ids`` (with a flag for null) are
    the owners'. Nodes are numbered level by level, so a node's children are neighbours.
    """

    def __init__(self, owner, rank, tf, m, ids: list[tuple[int, bool]], k: int):
        self.visited = 0
        begin = np.searchsorted(owner, np.arange(len(m) + 1))
        paths, counts = rank.astype(">u4").tobytes(), tf.astype(">u4").tobytes()
        same: dict[tuple, list[int]] = {}
        for i in range(len(m)):
            a, b = 4 * int(begin[i]), 4 * int(begin[i + 1])
            if a < b:  # a document without an item's term scores nothing
                same.setdefault((paths[a:b], counts[a:b], int(m[i])), []).append(i)
        leaves = sorted(same)
        owners = np.array([same[x][0] for x in leaves], np.int64)
        self.docs = [sorted(ids[i] for i in same[x])[:k] for x in leaves]
        if leaves:
            self._branch([x[0] for x in leaves])
            self._bound(owners, begin, rank, tf, m)

    def _branch(self, paths: list[bytes]) -> None:
        """Nodes as ranges of sorted leaves: ``parent``, ``first`` child, number of ``children``, ``leaf`` or -1."""
        shared = np.zeros(len(paths) + 1, np.int64)
        for i in range(1, len(paths)):
            a, b = (np.frombuffer(p, np.uint32) for p in paths[i - 1 : i + 1])
            n = min(len(a), len(b))
            apart = np.flatnonzero(a[:n] != b[:n])
            shared[i] = apart[0] if len(apart) else n
        low, high, parent, first, children = [0], [len(paths)], [-1], [], []
        self.levels = [0]
        at = 0
        while at < len(low):
            self.levels.append(len(low))
            for node in range(at, len(low)):
                a, b = low[node], high[node]
                if b - a < 2 and node:
                    first.append(-1)
                    children.append(0)
                    continue
                if b - a <= LEAVES:
                    cuts = list(range(a, b + 1))
                else:
                    inner = shared[a + 1 : b]
                    cuts = [a, *(np.flatnonzero(inner == inner.min()) + a + 1).tolist(), b]
                first.append(len(low))
                children.append(len(cuts) - 1)
                low += cuts[:-1]
                high += cuts[1:]
                parent += [node] * (len(cuts) - 1)
            at = self.levels[-1]
        self.parent, self.first, self.children = (np.array(x, np.int64) for x in (parent, first, children))
        self.leaf = np.where(self.children == 0, np.array(low, np.int64), -1)

    def _bound(self, owners, begin, rank, tf, m) -> None:
        nodes = len(self.parent)
        self.nodes = nodes
        self.m, self.least = np.full(nodes, np.iinfo(np.int64).max), np.full(nodes, np.iinfo(np.int64).max)
        at = np.flatnonzero(self.leaf >= 0)
        held = owners[self.leaf[at]]
        self.m[at] = m[held]
        self.least[at] = [self.docs[i][0][0] for i in self.leaf[at]]
        size = begin[held + 1] - begin[held]
        entry = np.arange(size.sum()) + np.repeat(begin[held] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        node, term, most = np.repeat(at, size), rank[entry].astype(np.int64), tf[entry].astype(np.int64)
        out = [(node, term, most)]
        up = node, term, most  # entries not yet handed to parents, of any level
        for a, b in reversed(list(zip(self.levels[1:-1], self.levels[2:]))):
            np.minimum.at(self.m, self.parent[a:b], self.m[a:b])
            np.minimum.at(self.least, self.parent[a:b], self.least[a:b])
            here = up[0] >= a
            key = self.parent[up[0][here]] << 32 | up[1][here]
            order = np.argsort(key, kind="stable")
            key, most = key[order], up[2][here][order]
            start = np.flatnonzero(np.diff(key, prepend=-1))
            most = np.maximum.reduceat(most, start) if len(start) else most
            made = key[start] >> 32, key[start] & 0xFFFFFFFF, most
            out.append(made)
            up = tuple(np.concatenate([u[~here], x]) for u, x in zip(up, made))
        node, term, most = (np.concatenate(x) for x in zip(*out))
        key = term * nodes + node
        order = np.argsort(key, kind="stable")
        self.key, self.node, self.most = key[order], node[order].astype(np.int32), most[order].astype(np.int32)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offers ``best`` all documents that can be among its best, for terms given by rank."""
        if not self.docs:
            return
        stack = [(np.iinfo(np.int64).max, 0)]
        while stack:
            bound, node = stack.pop()
            if not best.open(bound, int(self.least[node])):
                continue
            self.visited += 1
            a = int(self.first[node])
            b = a + int(self.children[node])
            low, high = np.searchsorted(self.key, terms * self.nodes + a), np.searchsorted(self.key, terms * self.nodes + b)
            size = high - low
            entry = np.arange(size.sum()) + np.repeat(low - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            child, tf = self.node[entry], self.most[entry].astype(np.int64)
            part = np.repeat(weights, size) * (SCALE * tf // (1000 * tf + 8 * self.m[child]))
            bounds = np.zeros(b - a, np.int64)
            np.add.at(bounds, child - a, part)
            hopeful = np.flatnonzero(bounds >= max(1, -best.limit[0] if best.limit else 1))
            inner = []
            for i in hopeful[np.argsort(-bounds[hopeful], kind="stable")].tolist():
                score, leaf = int(bounds[i]), int(self.leaf[a + i])
                if leaf < 0:
                    inner.append((score, a + i))
                    continue
                for doc in self.docs[leaf]:
                    if not best.offer(score, doc):
                        break
            stack += reversed(inner)


FOUND = "item int, doc_id long, score long"


def _searcher(k: int, documents: int, length: int, rank, weights, items: list[np.ndarray], floors: dict[int, tuple], chunk: int):
    """``rank`` and ``weights`` by term; ``items`` hold the terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, floors.get(i)) for i in range(len(items))]
        ranked = [(np.sort(rank[x]).astype(np.int64), weights[x[np.argsort(rank[x])]]) for x in items]
        held: list[tuple] = []
        entries = 0

        def flush() -> None:
            nonlocal entries
            owner = np.repeat(np.arange(len(held)), [len(x[2]) // 4 for x in held])
            terms, tf = (np.frombuffer(b"".join(x[c] for x in held), np.int32) for c in (2, 3))
            by_rank = rank[terms]
            order = np.lexsort((by_rank, owner))
            m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x[1] * documents // length for x in held], np.int64)
            ids = [(x[0], False) if x[0] is not None else (np.iinfo(np.int64).max, True) for x in held]
            tree = Tree(owner[order], by_rank[order], tf[order], m, ids, k)
            for (t, w), b in zip(ranked, best):
                tree.search(t, w, b)
            held.clear()
            entries = 0

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                entries += len(row[2]) // 4
                if entries >= chunk:
                    flush()
        if held:
            flush()
        out = [(i, None if null else doc, -score) for i, b in enumerate(best) for score, doc, null in b.rows]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"]
        )

    return run


def _top(found: DataFrame, k: int, by: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(documents: DataFrame, items: list[tuple[str | None, bytes]], k: int, chunk: int) -> DataFrame | None:
    """Best documents of a block of items, given as (id, text); ``documents`` has an id and a text."""
    terms: dict[str | None, set[bytes]] = {}
    for item, text in items:
        for found in terms_of(text):
            terms.setdefault(item, set()).update(found)
    if not terms:
        return None
    words = sorted(set().union(*terms.values()))
    number = {w: i for i, w in enumerate(words)}
    vectors = stage(documents.mapInArrow(_vectors(words), VECTORS), "vectors")
    totals = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not totals[0]:
        return None
    counted = vectors.select("terms").mapInArrow(_frequencies(len(words)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(words), np.int64)
    for row in counted.collect():  # at most one row a term of the block's items
        df[row["term"]] = row["df"]
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((np.arange(len(words)), df))] = np.arange(len(words))
    weights = np.array([weight(totals[0], int(x)) for x in df], np.int64)
    names = list(terms)
    wanted = [np.array([number[w] for w in terms[x]], np.int64) for x in names]

    def search(rows: DataFrame, floors: dict[int, tuple]) -> DataFrame:
        return rows.mapInArrow(_searcher(k, totals[0], totals[1], rank, weights, wanted, floors, chunk), FOUND)

    share = int((1 << 20) * min(1.0, SAMPLE_DOCS / totals[0]))
    sample = vectors.where(F.pmod(F.xxhash64("doc_id", "n", "terms", F.lit(3)), F.lit(1 << 20)) < share)
    least = _top(search(sample.coalesce(8), {}), k, "item").where(F.col("rank") == k).collect()  # at most one row an item
    end = np.iinfo(np.int64).max
    floors = {r["item"]: (-r["score"], end if r["doc_id"] is None else r["doc_id"], r["doc_id"] is None) for r in least}
    best = _top(search(vectors, floors), k, "item")
    ids = documents.sparkSession.createDataFrame(list(enumerate(names)), "item int, item_id string")
    return best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, k: int = 10, chunk: int = CHUNK, per_block: int = ITEMS) -> DataFrame:
    """The ``k`` best of ``documents`` (doc_id, text) for each of ``items`` (item_id, text): item_id, rank from 1, doc_id, score."""
    kind = items.schema["item_id"].dataType
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("string").alias("item_id"), F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8").alias("text"))
    size = asked.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    blocks = max(partitions_for(size[0], per_block), partitions_for(size[1] or 0, ITEM_BYTES))
    dealt = F.pmod(F.xxhash64("item_id", F.lit(1)), F.lit(blocks))
    out = None
    for i in range(blocks):
        some = [(r["item_id"], bytes(r["text"])) for r in asked.where(dealt == i).collect()]  # one block's items
        best = _block(rows, some, k, chunk)
        if best is not None:
            out = best if out is None else out.unionByName(best)
    if out is None:
        out = documents.sparkSession.createDataFrame([], "item_id string, rank int, doc_id long, score long")
    return out.withColumn("item_id", F.col("item_id").cast(kind))
