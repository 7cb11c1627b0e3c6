"""Best-fit packing of documents into bins of bounded size, under conflicts.

Documents are cut into pieces of at most ``capacity`` words; pieces of a whole bin's size are bins of
their own. All other pieces are packed best fit, largest first: bins are ordered by their residual, and
the successor search goes from the smallest residual that fits upwards until it finds a
compatible bin. A bin carries two bitmaps, of the sources and of the duplicate clusters it holds: a
piece is compatible if the bin doesn't hold its cluster and, of its source, holds fewer pieces than
``per_source`` allows (a bin has one bitmap per allowed piece). Clusters are exact copies up to white
space and case, or a given column; ``near_clusters`` joins near copies to them.

Packing is done in shards of about ``SHARD`` pieces, dealt by a hash of the id, so that a source or
cluster with a third of all rows is spread over all of them; a cluster's copies never share a bin,
in whichever shard they are. Only ids, sizes and keys are shuffled, not texts.

Defined results: null and empty texts are pieces of size 0 and take a place in a bin like others; a
null source is a source of its own; repeated rows are copies of each other; rows with null ids
are packed like others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from . import ngram_join
from .common import SPACE, frugal, partitions_for, small_batches
from .components import components, narrow
from .shingles import word_sequences

SHARD, PIECES_PER_FILE = 2048, 250_000
CAPACITY, PER_SOURCE = 2048, 4


class Bins:
    """Open bins ordered by residual; the bitmaps are integers of any width."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def place(self, size: int, source: int, cluster: int) -> int:
        """The tightest compatible bin, or a new one; ties go to the older bin."""
        at = bisect_left(self.order, (size, -1))
        found = -1
        while at < len(self.order):
            b = self.order[at][1]
            if not self.clusters[b] >> cluster & 1 and not self.sources[b][-1] >> source & 1:
                found = b
                break
            at += 1
        if found < 0:
            found = len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
            residual = self.capacity
        else:
            residual = self.order.pop(at)[0]
        insort(self.order, (residual - size, found))
        self.clusters[found] |= 1 << cluster
        for i, bitmap in enumerate(self.sources[found]):
            if not bitmap >> source & 1:
                self.sources[found][i] = bitmap | 1 << source
                break
        return found


def pack_shard(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[int]:
    """Bin of each piece; pieces are taken largest first, ties in the given order."""
    source_bit = {s: i for i, s in enumerate(dict.fromkeys(sources))}
    cluster_bit = {c: i for i, c in enumerate(dict.fromkeys(clusters))}
    bins, out = Bins(capacity, per_source), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        out[i] = bins.place(sizes[i], source_bit[sources[i]], cluster_bit[clusters[i]])
    return out


RESULT = "doc_id long, piece long, start long, size long, source string, cluster long, shard int, bin int"


def _packer(capacity: int, per_source: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_id", "piece", "cluster", "source"], na_position="first", kind="stable").reset_index(drop=True)
        bins = pack_shard(rows["size"].tolist(), rows["source"].tolist(), rows["cluster"].tolist(), capacity, per_source)
        out = rows.assign(bin=np.array(bins, np.int32), doc_id=pd.to_numeric(rows["_id"]).astype("Int64"))
        return out[[c.split()[0] for c in RESULT.split(", ")]]

    return run


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")).cast("long")


def same_text(text: Column) -> Column:
    """Key of a text up to case and white space."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))))


def pack(
    documents: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    cluster: Column | None = None,
    size: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """One row per piece: document, piece number, first word, words, and ``bin_id``.

    ``key`` tells texts of one id apart, by default the cluster.
    """
    text = F.col("text").cast("string")
    slim = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"),
        (same_text(text) if cluster is None else cluster.cast("long")).alias("cluster"),
        (word_count(text) if size is None else size.cast("long")).alias("words"),
        *([] if key is None else [key.cast("long").alias("key")]),
    ).withColumn("key", F.col("cluster" if key is None else "key"))
    pieces = slim.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0).cast("long"))))
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("words") - F.col("piece") * capacity).alias("size"),
        "source",
        "cluster",
        "key",
    )
    rows = documents.count()
    shards = partitions_for(rows, SHARD)
    shard = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(shards)).cast("int")
    whole = F.col("size") == capacity
    source = F.when(F.col("source") != "", F.expr("substring(source, 2)"))
    full = pieces.where(whole).select(
        "doc_id", "piece", "start", "size", source.alias("source"), "cluster",
        F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex("key"), "piece").alias("bin_id"),
    )
    rest = (
        pieces.where(~whole)
        .withColumn("shard", shard)
        .withColumn("_id", F.col("doc_id").cast("string"))
        .select("_id", "piece", "start", "size", "source", "cluster", "shard")
        .groupBy("shard")
        .applyInPandas(_packer(capacity, per_source), RESULT)
        .select(
            "doc_id", "piece", "start", "size", source.alias("source"), "cluster",
            F.concat_ws("-", F.lit("bin"), "shard", "bin").alias("bin_id"),
        )
    )
    # Narrow rows from many shards: few files hold them.
    return full.unionByName(rest).repartition(partitions_for(rows, PIECES_PER_FILE))


MEASURED = "doc_id long, source string, words long, same long"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words of each text, and a key of their sequence in lower case."""
    for batch in batches:
        words, same = word_sequences([(t or "").lower() for t in batch.column(2).to_pylist()])
        columns = [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(same.view(np.int64), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "words", "same"])


def near_clusters(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``source``, ``words``, ``same`` (key of the text) and ``cluster`` of every row.

    A cluster joins documents over any number of links, by ``percent`` of equal shingles of ``k`` words or as
    copies up to case and white space. Rows with null ids have only their copies.
    """
    narrow_rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")
    )
    with small_batches(documents.sparkSession):
        slim = stage(narrow_rows.mapInArrow(frugal(_measure), MEASURED), "slim")
    rows = slim.count()
    near = ngram_join.link(documents, k, percent).where("component_id <> id").select(F.col("id").alias("a"), F.col("component_id").alias("b"))
    first = stage(narrow(slim.groupBy("same").agg(F.min("doc_id").alias("first")), rows), "first")
    copies = slim.join(first, "same").where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    labels, _ = components(near.unionByName(copies).distinct(), rows, "clusters")
    # A null id takes the cluster of its copies' smallest id.
    named = slim.join(first, "same").withColumn("at", F.coalesce("doc_id", "first"))
    found = named.join(labels, F.col("at") == F.col("node"), "left")
    return stage(found.select("doc_id", "source", "words", "same", F.coalesce("component", "at", "same").alias("cluster")), "clustered")
