"""Exact similarity join of shingle sets by parity sketches.

Which texts are linked by a Jaccard similarity of ``percent`` or more is found in five steps:

1. Each text becomes a set of shingles and signs (``signatures``) with the parts of its parity
   sketch per size band, by the pigeonhole rule of which two similar sets share at least one.
   Frequent shingles are left out of a sketch as long as enough others remain: leaving the same
   elements out of both sets never makes them differ more. Which ones count as frequent comes from a
   sample, and any choice gives the same links, so passages that many documents share don't
   make them candidates of each other.
2. Texts that share a signature are joined into candidate groups (connected components of stars, not
   pairs). A signature that many texts of a batch share leaves the batch once, so a hot one meets
   few rows.
3. Groups grow faster than the input, since chance joins texts that have little in common, so they are narrowed before
   whole sets are moved. They are cut into blocks of bounded size, by size band and hash; each pair of blocks whose
   bands can hold similar sets is one task's work. There a parity sketch of each set, wide enough
   for its size, rules out pairs by Hamming distance. Components of the pairs that are left are the narrower groups.
4. Those are cut into blocks likewise, and pairs that sketches don't rule out are verified on the whole sets, about
   ``SENT`` sets at a time. Only links that join two texts not yet joined within the task are returned.
5. Components of the verified links.

Equal sets are found by a hash of 128 bits and represented by their smallest id in steps 2 and 3.

Defined results: null texts and texts without words have an empty set and are linked with nothing;
rows with a null id have a null component and are linked with nothing; rows that share an id are
one document for the links and are each returned with their own set's size; an empty table gives
no rows; further columns are ignored, or kept by ``keep_one``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import discard, stage
from .common import beside, free_name, frugal, partitions_for, small_batches
from .components import ROWS, components, narrow
from .shingles import groups, mix, shingle_sets

ONE = np.uint64(1)
GROUP_CHARS = 4 << 20  # texts signed together in a task
KEY_BYTES = 24 << 20  # bytes of text whose signatures meet in one task
SAMPLE_DOCS, FREQUENT, MOST_FREQUENT = 5000, 3, 200_000
BLOCK_DOCS, BLOCK_ELEMENTS = 512, 4 << 20
NEAR_DOCS, NEAR_ELEMENTS = 2048, 1 << 40  # of blocks of sketches, whose size is bounded by their width
MOST_WORDS = 64  # of a sketch, 64 bits each
SENT = 500_000  # rows that say where sets go, sent to all tasks at once
RARE = 0.35  # share of a band's size that must remain to leave frequent shingles out
SPARE = 0.25  # spare parts per part


def most_apart(percent: int, a, b):
    """Largest symmetric difference of similar sets of sizes ``a`` and ``b``."""
    return (100 - percent) * (a + b) // (100 + percent)


@functools.cache
def bands(percent: int, power: int) -> np.ndarray:
    """First sizes of the bands up to ``2**power``; a band [l, r] ends at floor(100 l / percent).

    Similar sets are of the same or of neighbouring bands.
    """
    out = [1]
    while out[-1] <= 1 << power:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, np.int64)


def band_of(percent: int, n: int) -> int:
    return int(np.searchsorted(bands(percent, int(n).bit_length() + 1), n, "right")) - 1


def signatures(whole: np.ndarray, rare: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set, of which two similar sets share at least one.

    For its own band and the next, a set signs with parts of its sketch. Similar sets of a band
    differ in at most ``d`` elements, so of ``m`` parts at least ``m - d`` are equal as sets. Each set
    leaves out its ``m - d - 1`` least parts, in an order by content alone (fewest elements first):
    the greatest of the equal parts is then left out by neither.

    The same holds for the sets without frequent shingles. A set signs with ``rare`` if at least
    ``RARE`` of the band's size remains, and with ``whole`` unless ``d`` more than that remains; as
    similar sets' remainders differ by at most ``d``, one of the two is signed by both.
    """
    return sign_many(whole, np.array([len(whole)]), np.isin(whole, rare, assume_unique=True), percent)[0]


def sign_many(elements: np.ndarray, sizes: np.ndarray, rare: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``signatures`` of many sets that lie end to end, none empty: keys, and which set each is of.

    ``rare``: per element whether it isn't frequent.
    """
    first = bands(percent, int(sizes.max(initial=1)).bit_length() + 1)
    own = np.searchsorted(first, sizes, "right") - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    remain = np.bincount(owner[rare], minlength=len(sizes))
    keys, owners = [], []
    for band in (own, own + 1):
        last = first[band] * 100 // percent
        d = most_apart(percent, last, last)
        m = d + 1 + np.ceil(SPARE * d).astype(np.int64)
        salt = (2 * band + 1).astype(np.uint64)
        for mode, signs in ((1, remain >= RARE * last), (0, remain < RARE * last + d)):
            who = np.flatnonzero(signs)
            if not len(who):
                continue
            taken = signs[owner] & rare if mode else signs[owner]
            of = owner[taken]
            h = mix(elements[taken] + salt[of])
            parts = m[who]
            begin = np.cumsum(parts) - parts
            offset = np.zeros(len(sizes), np.int64)
            offset[who] = begin
            part = (((h >> np.uint64(32)) * m[of].astype(np.uint64)) >> np.uint64(32)).astype(np.int64) + offset[of]
            total = int(parts.sum())
            # The part's 64 bits of the sketch, and a sum that tells sets of equal parity apart.
            parity, added = np.zeros(total, np.uint64), np.zeros(total, np.uint64)
            np.bitwise_xor.at(parity, part, ONE << (h & np.uint64(63)))
            np.add.at(added, part, mix(h))
            count = np.bincount(part, minlength=total)
            name = np.arange(total, dtype=np.uint64) - np.repeat(begin, parts).astype(np.uint64)
            name += np.repeat((4 * band[who] + mode).astype(np.uint64) << np.uint64(32), parts)
            key = mix(mix(parity ^ mix(added)) ^ mix(name))
            # Order by content: the number of elements, then the key.
            order = np.minimum(count, 15).astype(np.uint64) << np.uint64(60) | key >> np.uint64(4)
            stays = np.ones(total, bool)
            for a, n, left in zip(begin.tolist(), parts.tolist(), (parts - d[who] - 1).tolist()):
                if left > 0:
                    mine = order[a : a + n]
                    stays[a : a + n] = mine > np.partition(mine, left - 1)[left - 1]
            keys.append(key[stays])
            owners.append(np.repeat(who, parts)[stays])
    return np.concatenate(keys), np.concatenate(owners)


def _stars(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest owners, and distinct (smallest, other) owners of a key."""
    if not len(keys):
        return keys, owners, np.zeros((0, 2), np.int64)
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(begin, len(keys)))
    centre = np.repeat(owners[begin], size)
    other = centre != owners
    edges = np.unique(np.stack([centre[other], owners[other]], 1), axis=0)
    return keys[begin], owners[begin], edges


def sketch_words(percent: int, sizes: np.ndarray) -> np.ndarray:
    """Width of the sketches of sets, a power of two by their band."""
    first = bands(percent, int(sizes.max(initial=1)).bit_length() + 1)
    last = first[np.searchsorted(first, sizes, "right") - 1] * 100 // percent
    least = np.maximum(1, most_apart(percent, last, last) // 8)
    return np.minimum(MOST_WORDS, 1 << np.ceil(np.log2(least)).astype(np.int64))


def parities(elements: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Parity sketches, end to end, of sets that lie end to end: every element flips one bit. Of a power of two of
    words, a sketch's halves added up are the sketch of half the width."""
    words = sketch_words(percent, sizes)
    begin = np.repeat(np.cumsum(words) - words, sizes)
    bit = (mix(elements) >> np.uint64(32)).astype(np.int64) & (64 * np.repeat(words, sizes) - 1)
    out = np.zeros(int(words.sum()), np.uint64)
    np.bitwise_xor.at(out, begin + (bit >> 6), ONE << (bit & 63).astype(np.uint64))
    return out


# Rows between the two steps: kinds and what their packed arrays hold.
SIGNED, EQUAL, EDGE, COPY, DOC, NAMELESS, SKETCH = range(7)
PACKED = "bucket int, kind int, keys binary, checks binary, owners binary"


def _pack(bucket: int, kind: int, keys=(), checks=(), owners=()) -> tuple:
    as_bytes = lambda x, t: np.asarray(x, t).tobytes()
    return bucket, kind, as_bytes(keys, np.uint64), as_bytes(checks, np.uint64), as_bytes(owners, np.int64)


def _signer(k: int, percent: int, buckets: int, frequent):
    def split(kind, keys, checks, owners):
        """Packed rows by bucket; ``keys`` are sorted, buckets are ranges of them."""
        where = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        begin = np.flatnonzero(np.diff(where.astype(np.int64), prepend=-1))
        for a, b in zip(begin, np.append(begin[1:], len(keys))):
            yield _pack(int(where[a]), kind, keys[a:b], checks[a:b], owners[a:b])

    def sign(ids: list, texts: list[str]) -> Iterator[tuple]:
        common = frequent.value
        elements, sizes = shingle_sets(texts, k)
        end = np.cumsum(sizes)
        named = np.array([i for i, d in enumerate(ids) if d is not None], np.int64)
        number = np.array([-1 if d is None else int(d) for d in ids], np.int64)
        at = int(number[named[0]]) % buckets if len(named) else 0
        yield _pack(at, DOC, sizes[named], (), number[named])
        if len(named) < len(ids):
            yield _pack(at, NAMELESS, [n for n, d in zip(sizes, ids) if d is None])
        # Equal sets of the batch: the smallest id stands for them.
        named = named[sizes[named] > 0]
        named = named[np.argsort(number[named], kind="stable")]
        if not len(named):
            return
        sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x))) for x in (mix(elements), mix(elements ^ np.uint64(0x5851F42D4C957F2D)))]
        one, two = (s[end[named]] - s[end[named] - sizes[named]] for s in sums)
        names = np.stack([one ^ sizes[named].astype(np.uint64), two], 1)
        _, first, same = np.unique(names, axis=0, return_index=True, return_inverse=True)
        leader = first[same.reshape(-1)]
        copies = np.stack([number[named[leader]], number[named]], 1)
        copies = np.unique(copies[copies[:, 0] != copies[:, 1]], axis=0)
        if len(copies):
            yield _pack(at, COPY, copies[:, 0].astype(np.uint64), (), copies[:, 1])
        order = first[np.argsort(names[first, 0], kind="stable")]
        yield from split(EQUAL, names[order, 0], names[order, 1], number[named[order]])
        reps = named[np.sort(first)]
        if len(reps) < len(sizes):
            kept = np.zeros(len(sizes), bool)
            kept[reps] = True
            elements = elements[np.repeat(kept, sizes)]
            reps = np.flatnonzero(kept)
        yield _pack(at, SKETCH, sizes[reps], parities(elements, sizes[reps], percent), number[reps])
        rare = np.ones(len(elements), bool)
        if len(common):
            rare = common[np.minimum(np.searchsorted(common, elements), len(common) - 1)] != elements
        keys, owners = sign_many(elements, sizes[reps], rare, percent)
        keys, owners, edges = _stars(keys, number[reps][owners])
        yield from split(SIGNED, keys, np.zeros(0, np.uint64), owners)
        if len(edges):
            yield _pack(at, EDGE, edges[:, 0].astype(np.uint64), (), edges[:, 1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PACKED.split(", ")]
        for ids, texts in gathered(((b["id"], b["text"]) for b in batches), GROUP_CHARS):
            yield pd.DataFrame(list(sign(ids, texts)), columns=names)

    return frugal(run)


def gathered(batches: Iterator[tuple], limit: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of batches in lists of about ``limit`` characters, whatever the batches' size."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for some, of in batches:
        for i, t in zip(some, of):
            ids.append(None if pd.isna(i) else i)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


FOUND = "kind int, a long, b long, sketch binary"


def _meeter(percent: int):
    return lambda frame: _meet(frame, percent)


def _meet(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """What one bucket's signatures link: rows of kind EDGE, COPY (smallest, other), DOC (id, size), SKETCH (id, size,
    sketch)."""

    def column(kind: int, name: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(frame.loc[frame["kind"] == kind, name]), dtype)

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"kind": kind, "a": pd.array(a, "Int64"), "b": pd.array(b, "Int64"), "sketch": None})

    sizes, ids = column(DOC, "keys", np.uint64).astype(np.int64), column(DOC, "owners", np.int64)
    nameless = column(NAMELESS, "keys", np.uint64).astype(np.int64)
    edges = _stars(column(SIGNED, "keys", np.uint64), column(SIGNED, "owners", np.int64))[2]
    local = np.stack([column(EDGE, "keys", np.uint64).astype(np.int64), column(EDGE, "owners", np.int64)], 1)
    edges = np.unique(np.concatenate([edges, local]), axis=0)
    keys, checks, owners = (column(EQUAL, c, t) for c, t in (("keys", np.uint64), ("checks", np.uint64), ("owners", np.int64)))
    # Equal in both hashes: one key of the two, since a bucket holds all rows of the first.
    equal = _stars(mix(keys) ^ checks, owners)[2]
    local = np.stack([column(COPY, "keys", np.uint64).astype(np.int64), column(COPY, "owners", np.int64)], 1)
    equal = np.unique(np.concatenate([equal, local]), axis=0)
    nothing = pd.array([pd.NA] * len(nameless), "Int64")
    made = column(SKETCH, "keys", np.uint64).astype(np.int64)
    last = np.cumsum(8 * sketch_words(percent, made)).tolist()
    packed = b"".join(frame.loc[frame["kind"] == SKETCH, "checks"])
    sketched = rows(SKETCH, column(SKETCH, "owners", np.int64), made)
    sketched["sketch"] = [packed[a:b] for a, b in zip([0, *last], last)]
    return pd.concat(
        [
            rows(DOC, ids, sizes),
            pd.DataFrame({"kind": DOC, "a": nothing, "b": pd.array(nameless, "Int64"), "sketch": None}),
            sketched,
            rows(EDGE, edges[:, 0], edges[:, 1]),
            rows(COPY, equal[:, 0], equal[:, 1]),
        ],
        ignore_index=True,
    )


def _frequent(rows: DataFrame, k: int) -> np.ndarray:
    """Shingles that several documents of a sample hold, the most frequent first, sorted by hash.

    At most ``MOST_FREQUENT`` of about ``SAMPLE_DOCS`` documents; any set of them gives right links.
    """
    total = rows.count()
    share = int((1 << 20) * min(1.0, SAMPLE_DOCS / max(1, total)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"h": shingle_sets(list(batch["text"]), k)[0].view(np.int64)})

    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < share).select("text")
    counts = sample.mapInPandas(frugal(run), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
    held = counts.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").toPandas()["h"].to_numpy(np.int64)
    return np.sort(held.view(np.uint64))


def sketches(sets: list[np.ndarray], words: int) -> np.ndarray:
    """Parity sketches of ``64 * words`` bits: every element flips one bit."""
    out = np.zeros((len(sets), 64 * words), np.uint8)
    for i, s in enumerate(sets):
        bit = ((mix(s) >> np.uint64(32)) * np.uint64(64 * words)) >> np.uint64(32)
        out[i] = np.bincount(bit.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(out, axis=1).view(np.uint64)


def block_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, cross: bool, percent: int) -> list[tuple[int, int]]:
    """Links that join what earlier links of the block did not, of all similar pairs.

    ``cross``: only pairs of different sides.
    """
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    ids, side, sets = ids[order], side[order], [sets[i] for i in order]
    n = np.array([len(s) for s in sets], np.int64)
    words = int(min(64, max(1, most_apart(percent, n[-1], n[-1]) // 8)))

    def similar(i: int, j: int) -> bool:
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return 100 * both >= percent * (n[i] + n[j] - both)

    return _joined(ids, n, sketches(sets, words), side, cross, percent, similar)


def _joined(
    ids: np.ndarray, n: np.ndarray, sketch: np.ndarray, side: np.ndarray, cross: bool, percent: int, similar: Callable[[int, int], bool]
) -> list[tuple[int, int]]:
    """Pairs, of sets in the order of their sizes ``n``, that sketches don't rule out and ``similar`` holds for; of
    these the ones that join what earlier ones did not."""
    joined = np.arange(len(ids))
    words = np.ascontiguousarray(sketch.T)
    out = []
    for i in range(len(ids) - 1):
        end = int(np.searchsorted(n, n[i] * 100 // percent, "right"))
        rest = slice(i + 1, end)
        apart = np.bitwise_count(words[:, rest] ^ words[:, i : i + 1]).sum(0, dtype=np.int64)
        near = (apart <= most_apart(percent, n[i], n[rest])) & (joined[rest] != joined[i])
        if cross:
            near &= side[rest] != side[i]
        for j in np.flatnonzero(near) + i + 1:
            if joined[j] != joined[i] and similar(i, j):
                out.append((int(ids[i]), int(ids[j])))
                joined[joined == joined[j]] = joined[i]
    return out


def close_links(
    ids: np.ndarray, sizes: np.ndarray, packed: list[bytes], side: np.ndarray, cross: bool, percent: int
) -> list[tuple[int, int]]:
    """As ``block_links``, of all pairs that their sketches don't rule out."""
    order = np.lexsort((ids, sizes))
    words = int(min(len(x) for x in packed)) // 8
    sketch = np.empty((len(ids), words), np.uint64)
    for at, i in enumerate(order):
        own = np.frombuffer(packed[i], np.uint64)
        while len(own) > words:
            own = own[: len(own) // 2] ^ own[len(own) // 2 :]
        sketch[at] = own
    return _joined(ids[order], sizes[order], sketch, side[order], cross, percent, lambda i, j: True)


def _narrower(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in frame.groupby("part", sort=False):
            if len(rows) > 1:
                ids, sizes, side = rows["id"].to_numpy(np.int64), rows["size"].to_numpy(np.int64), rows["side"].to_numpy()
                out += close_links(ids, sizes, list(rows["sketch"]), side, bool(rows["crossed"].iloc[0]), percent)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _verifier(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in frame.groupby("part", sort=False):
            if len(rows) > 1:
                sets = [np.frombuffer(x, np.uint64) for x in rows["elements"]]
                out += block_links(
                    rows["id"].to_numpy(np.int64), sets, rows["side"].to_numpy(), bool(rows["crossed"].iloc[0]), percent
                )
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _setter(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            for a, b in groups([len(t or "") for t in texts], GROUP_CHARS):
                part = batch.iloc[a:b].drop(columns="text")
                elements, sizes = shingle_sets(texts[a:b], k)
                cuts = np.split(elements, np.cumsum(sizes)[:-1])
                yield part.assign(elements=[x.tobytes() for x in cuts])

    return frugal(run)


def _blocks(live: DataFrame, most_docs: int, most_elements: int, *carried: str) -> DataFrame:
    """Per candidate document the units of work it goes to: (unit, part, side, crossed), with ``carried`` columns.

    ``live``: id, size, band and group. A group of one block's size is one part, and such groups
    share units; a larger group is cut by band and hash into blocks, and every pair of blocks of
    the same or neighbouring bands is a part and a unit of its own.
    """
    sizes = live.groupBy("grp").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("elements"))
    sizes = sizes.where("docs > 1")
    small = (F.col("docs") <= most_docs) & (F.col("elements") <= most_elements)
    totals = sizes.where(small).agg(F.sum("docs"), F.sum("elements")).first()
    units = max(partitions_for(totals[0] or 0, most_docs // 2), partitions_for(totals[1] or 0, most_elements))
    pooled = live.join(sizes.where(small).select("grp"), "grp").select(
        "id",
        *carried,
        F.concat(F.lit("p"), F.pmod(F.xxhash64("grp"), F.lit(units)).cast("string")).alias("unit"),
        F.col("grp").cast("string").alias("part"),
        F.lit(0).alias("side"),
        F.lit(False).alias("crossed"),
    )
    large = live.join(sizes.where(~small).select("grp"), "grp")
    counts = large.groupBy("grp", "band").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / most_docs), F.ceil(F.sum("size") / most_elements)
        ).cast("int").alias("blocks")
    )
    own, up, down = (counts.select("grp", (F.col("band") + s).alias("band"), F.col("blocks").alias(c)) for s, c in ((0, "own"), (-1, "up"), (1, "down")))
    placed = large.join(own, ["grp", "band"]).join(up, ["grp", "band"], "left").join(down, ["grp", "band"], "left")
    mine = F.pmod(F.xxhash64("id", F.lit(3)), F.col("own"))
    name = lambda b1, i1, b2, i2: F.concat_ws("/", *[x.cast("string") for x in (F.col("grp"), b1, i1, b2, i2)])
    pair = lambda j, b, side, crossed, unit: F.struct(unit.alias("unit"), side.alias("side"), crossed.alias("crossed"))
    band = F.col("band")
    to = lambda column: F.when(F.col(column) > 0, F.sequence(F.lit(0), F.col(column) - 1)).otherwise(F.array().cast("array<int>"))
    within = F.transform(
        to("own"),
        lambda j: pair(
            j, band, F.when(F.col("mine") <= j, 0).otherwise(1), F.col("mine") != j,
            name(band, F.least(F.col("mine"), j), band, F.greatest(F.col("mine"), j)),
        ),
    )
    above = F.transform(to("up"), lambda j: pair(j, band, F.lit(0), F.lit(True), name(band, F.col("mine"), band + 1, j)))
    below = F.transform(to("down"), lambda j: pair(j, band, F.lit(1), F.lit(True), name(band - 1, j, band, F.col("mine"))))
    spread = placed.withColumn("mine", mine.cast("int")).select("id", *carried, F.explode(F.concat(within, above, below)).alias("x"))
    crossed = spread.select("id", *carried, "x.unit", F.col("x.unit").alias("part"), "x.side", "x.crossed")
    return pooled.unionByName(crossed)


def _members(groups: DataFrame) -> DataFrame:
    """Id and group of every node of ``components``."""
    return groups.select(F.col("node").alias("id"), F.col("component").alias("grp")).unionByName(
        groups.select(F.col("component").alias("id"), F.col("component").alias("grp")).distinct()
    )


def _verified(rows: DataFrame, units: DataFrame, k: int, percent: int) -> DataFrame:
    """The links of all units, from the whole sets. Texts are never shuffled: ``units`` are sent to all tasks, about ``SENT``
    rows at a time, each a pass over the texts, whose sets are all that lies on disk."""
    sent = units.count()
    passes = partitions_for(sent, SENT)
    links = None
    for i in range(passes):
        some = units if passes == 1 else units.where(F.pmod(F.xxhash64("unit"), F.lit(passes)) == i)
        texts = rows.join(F.broadcast(some.select("id")), "id", "left_semi")
        sets = texts.mapInPandas(_setter(k), "id long, elements binary").join(F.broadcast(some), "id")
        found = sets.groupBy("unit").applyInPandas(_verifier(percent), "a long, b long")
        with small_batches(rows.sparkSession):
            found = stage(found.repartition(partitions_for(sent // passes, ROWS)), "linked")
        links = found if links is None else links.unionByName(found)
    return links


def link(documents: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` for every row of ``documents``, and the links of
    ``percent`` similarity that make the components."""
    if not 0 < percent < 100:
        raise ValueError("percent lies between 0 and 100")
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(size, KEY_BYTES))
    frequent = spark.sparkContext.broadcast(_frequent(rows, k))
    signed = rows.mapInPandas(_signer(k, percent, buckets, frequent), PACKED)
    met = signed.groupBy("bucket").applyInPandas(_meeter(percent), FOUND)
    with small_batches(spark):
        # Small tables are written by few tasks: their files cost more than their rows.
        found = stage(met.repartition(partitions_for(4 * size // 1000, ROWS)), "signed")
    frequent.unpersist()
    counts = {r["kind"]: r["n"] for r in found.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    pairs = lambda kind: found.where(F.col("kind") == kind).select("a", "b")
    copies, n_copies = pairs(COPY), counts.get(COPY, 0)
    # Only copies in other batches than their smallest id's signed at all; those are left out here.
    again = stage(narrow(copies.select(F.col("b").alias("node")).distinct(), n_copies), "copies")
    candidates, n_live = components(pairs(EDGE), counts.get(EDGE, 0), "candidates")
    edges = bands(percent, 40)
    band = F.size(F.filter(F.array(*[F.lit(int(x)) for x in edges]), lambda x: x <= F.col("size"))) - 1
    docs = found.where(F.col("kind") == SKETCH).select(F.col("a").alias("id"), F.col("b").alias("size"), "sketch")
    members = _members(candidates)
    signers = members.join(again, members["id"] == again["node"], "left_anti").join(docs, "id").withColumn("band", band)
    live = stage(narrow(signers, 2 * n_live), "live")
    near = _blocks(live, NEAR_DOCS, NEAR_ELEMENTS, "size", "sketch").groupBy("unit").applyInPandas(_narrower(percent), "a long, b long")
    closer, n_close = components(near, 2 * n_live, "closer")
    # Rows that share an id are one document here, of the size of its largest.
    largest = live.groupBy("id").agg(F.max("size").alias("size")).withColumn("band", band)
    units = stage(narrow(_blocks(_members(closer).join(largest, "id"), BLOCK_DOCS, BLOCK_ELEMENTS), 8 * n_close), "units")
    discard(live)
    linked = _verified(rows, units, k, percent)
    labels, _ = components(linked.unionByName(copies), n_live + n_copies, "links")
    return found.where(F.col("kind") == DOC).select(F.col("a").alias("id"), F.col("b").alias("n_shingles")).join(
        labels, F.col("id") == F.col("node"), "left"
    ).select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))


def keep_one(documents: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id") -> DataFrame:
    """The documents without those linked, over any number of links, to one of a smaller id.

    Of rows that share an id the first by text stays; rows without an id stay.
    """
    rows = documents.count()
    found = stage(narrow(link(documents, k, percent, doc_id), rows), "components")
    other, again, order = (free_name(documents, c) for c in ("_gone", "_twice", "_order"))
    gone = stage(narrow(found.where("component_id <> id").select(F.col("id").alias(other)).distinct(), rows), "gone")
    repeated = found.where("id IS NOT NULL").groupBy(F.col("id").alias(again)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = stage(narrow(repeated.select(again), rows), "twice")
    key = F.col(doc_id).cast("long")
    kept = documents.join(beside(gone), key == F.col(other), "left_anti")
    second, match = beside(twice), key == F.col(again)
    first = (
        kept.join(second, match, "left_semi")
        .withColumn(order, F.row_number().over(Window.partitionBy(key).orderBy("text", *[c for c in documents.columns if c != "text"])))
        .where(F.col(order) == 1)
        .drop(order)
    )
    return kept.join(second, match, "left_anti").unionByName(first)
