"""SimHash near-dedup: pigeonhole blocks, then Hamming distance.

``exact_links`` takes 64-bit fingerprints.  They are split into ``BLOCKS`` blocks; two that
differ in at most ``radius`` bits agree on all but ``radius`` of them, so they share the
key of some choice of the other blocks.  Rows meet on those keys (about half the bits long,
so that keys stay rare in large corpora) and every pair of a key's rows is compared, but
only a spanning forest of the close ones is returned.  A key with over ``MOST`` different
fingerprints is not compared in one task: its rows take keys of thirteen of sixteen blocks
instead, of which none can have more than 2 ** 12.

``near_groups`` links texts whose sets of word shingles have a Jaccard similarity of at
least ``SIMILAR``.  Fingerprints of ``WIDE`` bits and blocks of sixteen bits only find
candidates; the shingles of both texts decide.  So many bits differ at 0.8 that no split
guarantees a shared block; at 0.8 a pair shares one of the sixty with probability 0.99, at
0.9 with 0.99999, and groups are joined through any member.  Rows of a key are sifted by a
part of their bits; those that have a partner, few of all, carry their whole fingerprints on.
Their candidates come twice: first a forest of the closest pairs within each key, whose
similar pairs make groups; then every candidate in different groups, once, from the first block it shares.
So no pair is left out for another one that turns out not to be similar, and a group of many
copies does not make pairs of all.  A key with over ``MOST`` sets of shingles is dealt into
parts by a hash, and all parts meet two by two.

Copies share a fingerprint (in ``near_groups``, a set of shingles) and are folded before
blocks are made.

Defined results: null and empty texts have fingerprint 0 and are linked like any other by
``exact_links``; ``near_groups`` takes texts without words as copies of each other.  A null
``doc_id`` is a row of its component; the component's id is the smallest that is not null.
Repeated rows each get a row.  Empty tables give empty results.  Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import given, only, whole, width, written
from driftlake.llm.components import components

#: Blocks of a 64-bit fingerprint, and of one whose key is too common.
BLOCKS, FINE_BLOCKS = 6, 16
#: Fingerprints of a key that one task compares at most.
MOST = 4096
#: Groups up to this size are compared in one sweep over a batch.
SMALL = 48
#: Bits of a wide fingerprint, and how many at its start are not in a block.
WIDE, SIFT = 1024, 64
#: Bits that sift the rows of a key, and the most that may differ in the first 64 and in all.
FULL_SIFT, FIRST_RADIUS, FULL_RADIUS = 192, 24, 55
#: Words of a shingle, least similarity, and the share of bits that may differ in a candidate:
#: at 0.8 0.151 differ on average, 0.011 more or less, so one in five hundred such pairs is missed.
WORDS, SIMILAR, WIDE_RADIUS = 5, 0.8, 0.184


# -- fingerprints ----------------------------------------------------------------------
def fingerprint(text: str, words: int = 3) -> int:
    """64 bits: those set in over half the XXH64 values (seed 42) of the shingles."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = zip(*(parts[i:] for i in range(words))) if len(parts) >= words else [parts]
    count = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(s), 42) for s in joined), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The set of hashed shingles of a text, sorted; a shorter text is one shingle."""
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    own = np.fromiter((digest(part) for part in parts), np.uint64, len(parts))
    n = max(1, len(own) - words + 1)
    total = np.zeros(n, np.uint64)
    for j in range(min(words, len(own))):
        total = total * np.uint64(0x9E3779B97F4A7C15) + own[j : j + n]
    return np.unique(_mixed(total))


def wide_fingerprints(sets: list[np.ndarray]) -> list[bytes]:
    """Signs of ``WIDE`` random projections of sets of shingles.

    Shingles are counted under signed hashed places; a Walsh-Hadamard transform then sums
    them with all sign patterns at once.
    """
    counts = np.zeros((len(sets), WIDE), np.float32)
    for row, mixed in enumerate(sets):
        places = (mixed >> np.uint64(1)) % np.uint64(WIDE)
        signs = 1.0 - 2.0 * (mixed & np.uint64(1)).astype(np.float64)
        counts[row] = np.bincount(places.astype(np.int64), weights=signs, minlength=WIDE)
    step = 1
    while step < WIDE:
        pairs = counts.reshape(len(sets), -1, 2, step)
        counts = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        counts = counts.reshape(len(sets), WIDE)
        step *= 2
    return [bits.tobytes() for bits in np.packbits(counts > 0, axis=1)]


# -- pairs within keys -----------------------------------------------------------------
class _Forest:
    """Union-find over positions of a batch."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[a] = b
        return a != b


def _small_groups(begin: np.ndarray, size: np.ndarray, prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Forest edges (positions) of many small groups at once, closest pairs first."""
    rows = np.concatenate([np.empty(0, np.int64), *([np.repeat(begin + size, size)] if len(begin) else [])])
    at = np.repeat(begin, size) + (np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size))
    found = []
    ends = rows
    step = 1
    while len(at):
        inside = at + step < ends
        at, ends = at[inside], ends[inside]
        if len(at):
            apart = np.bitwise_count(prints[at] ^ prints[at + step])
            near = apart <= radius
            found.append(np.stack([apart[near].astype(np.int64), at[near], at[near] + step]))
        step += 1
    if not found:
        return []
    distance, a, b = np.concatenate(found, axis=1)
    order = np.argsort(distance, kind="stable")
    forest = _Forest()
    return [(x, y) for x, y in zip(a[order].tolist(), b[order].tolist()) if forest.join(x, y)]


def _one_group(begin: int, prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Forest edges of one group, grown by the closest pair each time."""
    left = np.arange(1, len(prints))
    nearest = np.zeros(len(left), np.int64)
    distance = np.bitwise_count(prints[1:] ^ prints[0]).astype(np.int64)
    edges = []
    while len(left):
        k = int(distance.argmin())
        x = int(left[k])
        if distance[k] <= radius:
            edges.append((begin + int(nearest[k]), begin + x))
        keep = np.arange(len(left)) != k
        left, nearest, distance = left[keep], nearest[keep], distance[keep]
        new = np.bitwise_count(prints[left] ^ prints[x])
        closer = new < distance
        distance[closer], nearest[closer] = new[closer], x
    return edges


LINKS = "a long, b long, common long"


def _linker(radius: int, most: int):
    """Rows ``key, print, id`` sorted by key to links ``a, b`` of ids.

    Rows of a key with over ``most`` rows come back as ``common`` (their id).
    """

    def out(edges: list[tuple[int, int]], common: np.ndarray | None = None) -> pa.RecordBatch:
        extra = np.empty(0, np.int64) if common is None else common
        a = pa.array([x for x, _ in edges] + [None] * len(extra), pa.int64())
        b = pa.array([y for _, y in edges] + [None] * len(extra), pa.int64())
        c = pa.array([None] * len(edges) + extra.tolist(), pa.int64())
        return pa.record_batch([a, b, c], names=["a", "b", "common"])

    def link(batches):
        key, prints, ids = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        open_key = None
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
            ids = np.concatenate([ids, batch.column(2).to_numpy()])
            if open_key is not None and len(key):
                own = int(np.searchsorted(key != open_key, True))
                if own:
                    yield out([], ids[:own])
                key, prints, ids = key[own:], prints[own:], ids[own:]
                if len(key):
                    open_key = None
            if not len(key):
                continue
            begin = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            size = np.diff(np.concatenate([begin, [len(key)]]))
            yield from closed(begin[:-1], size[:-1], prints, ids)
            last = int(begin[-1])
            if size[-1] > most:
                open_key = key[last]
                yield out([], ids[last:])
                last = len(key)
            key, prints, ids = key[last:], prints[last:], ids[last:]
        if len(key):
            yield from closed(np.array([0]), np.array([len(key)]), prints, ids)

    def closed(begin, size, prints, ids):
        few = (size > 1) & (size <= SMALL)
        edges = _small_groups(begin[few], size[few], prints, radius)
        for b, n in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist()):
            if n > most:
                yield out([], ids[b : b + n])
            else:
                edges += _one_group(b, prints[b : b + n], radius)
        if edges:
            yield out([(int(ids[a]), int(ids[b])) for a, b in edges])

    return link


def _within_keys(keyed: DataFrame, radius: int, most: int) -> DataFrame:
    """Links of ``key, print, id`` rows that share a key."""
    return (
        keyed.repartition(width(keyed.sparkSession), "key")
        .sortWithinPartitions("key", "print")
        .mapInArrow(_linker(radius, most), LINKS)
    )


def _whole_groups(batches):
    """The columns of whole groups, from batches sorted by their first column."""
    held = None
    for batch in batches:
        columns = [
            np.frombuffer(b"".join(x.to_pylist()), np.uint64).reshape(len(x), -1) if pa.types.is_binary(x.type) else x.to_numpy()
            for x in batch.columns
        ]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        if not len(columns[0]):
            continue
        last = int(np.argmax(columns[0] == columns[0][-1]))
        if last:
            yield [x[:last] for x in columns]
        held = [x[last:] for x in columns]
    if held is not None:
        yield held


def _members(batches):
    """Rows ``group, side, block, id, s0, s1, s2`` sorted by group to the first four of those with a sifted partner.

    Rows of side 0 meet all of their group, those of sides 1 and 2 only each other.
    """
    for group, side, block, ids, *sift in _whole_groups(batches):
        sift = [x.view(np.uint64) for x in sift]
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(begin, len(group)))
        at, ends = np.arange(len(group)), np.repeat(begin + size, size)
        step, found = 1, np.zeros(len(group), bool)
        while len(at):
            inside = at + step < ends
            at, ends = at[inside], ends[inside]
            a = at[(side[at] == 0) | (side[at] != side[at + step])]
            apart = np.bitwise_count(sift[0][a] ^ sift[0][a + step]).astype(np.int64)
            a, apart = a[apart <= FIRST_RADIUS], apart[apart <= FIRST_RADIUS]
            for x in sift[1:]:
                apart += np.bitwise_count(x[a] ^ x[a + step])
            a = a[apart <= FULL_RADIUS]
            found[a] = found[a + step] = True
            step += 1
        kept = [pa.array(x[found]) for x in (group, side, block, ids)]
        yield pa.record_batch(kept, names=["group", "side", "block", "id"])


def _candidate(prints: np.ndarray, n: np.ndarray, x: int, others: np.ndarray, similar: float) -> np.ndarray:
    """Bits in which ``others`` differ from ``x``; all of them where the sizes rule similarity out."""
    apart = np.bitwise_count(prints[others] ^ prints[x]).sum(axis=1).astype(np.int64)
    apart[np.minimum(n[others], n[x]) < similar * np.maximum(n[others], n[x]) - 1e-9] = WIDE
    return apart


def _groups_of(columns: list[np.ndarray]):
    begin = np.flatnonzero(np.append(True, columns[0][1:] != columns[0][:-1]))
    for low, high in zip(begin, [*begin[1:], len(columns[0])]):
        yield [x[low:high] for x in columns]


def _pair_batch(a: list, b: list) -> pa.RecordBatch:
    both = np.sort(np.stack([np.concatenate(a), np.concatenate(b)]), axis=0) if a else np.empty((2, 0), np.int64)
    return pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _closest(similar: float):
    """Rows ``group, id, n, print`` sorted by group to the edges of a forest of candidates, closest first."""

    def run(batches):
        for columns in _whole_groups(batches):
            a, b = [], []
            for _, ids, n, prints in _groups_of(columns):
                left = np.arange(1, len(ids))
                nearest, apart = np.zeros(len(left), np.int64), _candidate(prints, n, 0, left, similar)
                while len(left):
                    k = int(apart.argmin())
                    x = int(left[k])
                    if apart[k] <= WIDE_RADIUS * WIDE:
                        a.append(ids[[nearest[k]]])
                        b.append(ids[[x]])
                    keep = np.arange(len(left)) != k
                    left, nearest, apart = left[keep], nearest[keep], apart[keep]
                    new = _candidate(prints, n, x, left, similar)
                    closer = new < apart
                    apart[closer], nearest[closer] = new[closer], x
            yield _pair_batch(a, b)

    return run


def _between(similar: float):
    """Rows ``group, side, block, root, id, n, print`` sorted by group to all candidates of different roots.

    A pair comes from the first block it shares, so it comes once.
    """

    def run(batches):
        for columns in _whole_groups(batches):
            a, b, held = [], [], 0
            for _, side, block, root, ids, n, prints in _groups_of(columns):
                blocks = np.ascontiguousarray(prints).view(np.uint8).view(np.uint16)[:, SIFT // 16 :]
                for x in range(len(ids) - 1):
                    met = (side[x + 1 :] == 0) | (side[x + 1 :] != side[x])
                    others = x + 1 + np.flatnonzero(met & (root[x + 1 :] != root[x]))
                    others = others[_candidate(prints, n, x, others, similar) <= WIDE_RADIUS * WIDE]
                    others = others[(blocks[others] == blocks[x]).argmax(axis=1) == block[x]]
                    if len(others):
                        a.append(np.repeat(ids[x], len(others)))
                        b.append(ids[others])
                        held += len(others)
                    if held > 1 << 16:
                        yield _pair_batch(a, b)
                        a, b, held = [], [], 0
            yield _pair_batch(a, b)

    return run


def _choices(blocks: int, radius: int) -> list[int]:
    """Masks of all but ``radius`` of the blocks of 64 bits, as signed longs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(mask).alias("mask")) for i, mask in enumerate(masks)])
    return prints.select("print", F.explode(choices).alias("c")).select(
        F.xxhash64("c.choice", F.col("print").bitwiseAND(F.col("c.mask"))).alias("key"),
        "print",
        F.col("print").alias("id"),
    )


def exact_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a, b`` that connect whatever different ``print`` values within ``radius`` bits connect."""
    first = written(_within_keys(_keyed(prints, _choices(BLOCKS, radius)), radius, MOST), "links")
    common = written(first.filter("common IS NOT NULL").select(F.col("common").alias("print")).distinct(), "common")
    again = _within_keys(_keyed(common, _choices(FINE_BLOCKS, radius)), radius, MOST)
    return first.filter("a IS NOT NULL").select("a", "b").unionByName(again.select("a", "b"))


def _grouped(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, id, component_id`` for ``rows`` (``doc_id, id``) and links between ids."""
    ids = written(rows.groupBy("id").agg(F.min("doc_id").alias("first")), "print-ids")
    roots = components(links)
    nodes = written(
        ids.join(roots, ids["id"] == roots["node"], "left").select("id", "first", F.coalesce("root", "id").alias("root")),
        "print-roots",
    )
    least = written(nodes.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id")), "component-ids")
    named = nodes.join(least, nodes["root"] == least["r"]).select(F.col("id").alias("own"), "component_id")
    named = written(named, "print-components")
    return rows.join(named, rows["id"] == named["own"]).select("doc_id", "id", "component_id")


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""

    def own(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text or "", words) for text in texts], dtype="int64")

    column: Column = F.pandas_udf(own, "long")("text")
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), column.alias("id")), "prints")
    links = exact_links(rows.select(F.col("id").alias("print")).distinct(), radius)
    return _grouped(rows, links).select(
        "doc_id", F.lower(F.lpad(F.hex("id"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _set_id(shingle_set: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingle_set.tobytes())).view(np.int64))


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``id, set`` of the texts whose hash is in ``wanted``: their shingles, read once for all that follows."""

    def sets(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(text, words) for text in texts]
        return pd.DataFrame({"id": [_set_id(x) for x in found], "set": [x.tobytes() for x in found]})

    text = docs.select(whole("text").alias("text")).withColumn("own", F.xxhash64("text"))
    chosen = text.join(wanted.hint("merge"), "own", "left_semi").dropDuplicates(["own"])
    made = chosen.select(F.pandas_udf(sets, "id long, set binary")("text").alias("s"))
    return written(made.select("s.id", "s.set"), "wide-sets")


def _similar(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The ``pairs`` (``a, b`` of ids) whose sets are similar, by their shingles."""

    def enough(a: pd.Series, b: pd.Series) -> pd.Series:
        done = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            done.append(common >= similar * (len(x) + len(y) - common) - 1e-9)
        return pd.Series(done, dtype="bool")

    left, right = (sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
    both = written(pairs.distinct(), "wide-pairs").join(left, "a").join(right, "b")
    return written(both.filter(F.pandas_udf(enough, "boolean")("set_a", "set_b")).select("a", "b"), "wide-links")


def near_groups(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """``doc_id, component_id``: documents connected by shingle similarity."""

    def prints(texts: pd.Series) -> pd.DataFrame:
        done = []
        for start in range(0, len(texts), 256):
            sets = [shingles(text, words) for text in texts[start : start + 256]]
            done += zip(map(_set_id, sets), map(len, sets), wide_fingerprints(sets))
        return pd.DataFrame(done, columns=["id", "n", "print"])

    text = whole("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("own"),
        F.pandas_udf(prints, "id long, n long, print binary")(text).alias("p"),
    ).select("doc_id", "own", "p.*")
    rows = written(rows, "wide-prints")
    single = rows.groupBy("id").agg(F.min(F.struct("own", "n", "print")).alias("p")).select("id", "p.*")
    single = written(single, "wide-distinct")
    blocks = F.transform(
        F.sequence(F.lit(SIFT // 8 + 1), F.lit(WIDE // 8 - 1), F.lit(2)),
        lambda at: F.xxhash64(at, F.substring(F.col("print"), at, F.lit(2))),
    )
    sift = [
        F.conv(F.substring(F.hex("print"), 16 * i + 1, 16), 16, -10).cast("long").alias(f"s{i}") for i in range(FULL_SIFT // 64)
    ]
    keys = single.select("id", *sift, blocks.alias("keys"))
    sizes = keys.select(F.explode("keys").alias("common")).groupBy("common").count().filter(F.col("count") > MOST)
    common = written(sizes.select("common", F.ceil(2 * F.col("count") / MOST).cast("int").alias("parts")), "wide-common")
    part = F.pmod(F.xxhash64("key", "id"), F.coalesce("parts", F.lit(1))).cast("int")

    def dealt(keyed: DataFrame) -> DataFrame:
        """With ``part``, which of the parts of its key a row is in, and how many there are."""
        return keyed.join(common, keyed["key"] == common["common"], "left").withColumn("part", part)

    def group(*parts) -> Column:
        return F.when(F.col("parts").isNull(), F.col("key")).otherwise(F.xxhash64("key", *parts))

    def by_group(frame: DataFrame) -> DataFrame:
        return frame.repartition(width(docs.sparkSession), "group").sortWithinPartitions("group")

    other = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    keyed = dealt(keys.select("id", "s0", "s1", "s2", F.posexplode("keys").alias("block", "key")))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    keyed = keyed.withColumn("other", F.explode(other)).select(
        group(low, high).alias("group"),
        F.when(low == high, 0).when(F.col("part") == low, 1).otherwise(2).alias("side"),
        "block", "id", "s0", "s1", "s2",
    )
    members = written(by_group(keyed).mapInArrow(_members, "group long, side int, block int, id long"), "wide-members")
    # Few rows have a partner; they alone carry their fingerprints and sets on.
    partners = written(single.join(members.select("id").distinct(), "id", "left_semi"), "wide-partners")
    members = members.join(partners.drop("own"), "id")
    sets = _sets(docs, partners.select("own"), words)
    closest = by_group(members.select("group", "id", "n", "print")).mapInArrow(_closest(similar), "a long, b long")
    first = _similar(closest, sets, similar)
    rooted = members.join(components(first).withColumnRenamed("node", "id"), "id", "left")
    rooted = rooted.select("group", "side", "block", F.coalesce("root", "id").alias("root"), "id", "n", "print")
    rest = by_group(rooted).mapInArrow(_between(similar), "a long, b long")
    links = first.unionByName(_similar(rest, sets, similar))
    return _grouped(rows.select("doc_id", "id"), links).select("doc_id", "component_id")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each group of near copies (its smallest ``doc_id``), columns unchanged."""
    groups = near_groups(docs, **options)
    return only(docs, written(groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-kept"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(given(spark, folder, "documents"))
