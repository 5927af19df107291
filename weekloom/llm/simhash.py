"""SimHash near-duplicates: 64-bit fingerprints linked by BK-trees over exact shards.

Every text becomes one fingerprint of its word shingles. Two fingerprints within
``radius`` bits agree on at least ``agree`` of ``radius + agree`` bit ranges, so the
fingerprints that share such ranges form a shard, and every link lies in some shard. A
shard is one BK-tree: children are keyed by their Hamming distance to the parent, and a
search follows only edges within the radius. Shards go to tasks by a shuffle rather than
by broadcast, because a tree over the corpus grows with it.

Equal texts meet in one fingerprint before any linking, and a shard gives the edges of a
spanning forest, never all its pairs. A shard beyond ``MAX_SHARD`` is cut again by the
bits it does not share yet; what is still larger is compared block against block, each
pair of blocks in a task of its own. No link is lost in either step.

Null and empty texts have fingerprint zero and link like any other. Repeated rows each
get a row. A null id never becomes a component's id unless all of its ids are null. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import keep_rows, long_rows, pick, row_key
from weekloom.llm.components import components
from weekloom.sources.staging import stage

SHINGLE = 4
RADIUS = 4
SEED = 42
MAX_SHARD = 4096
#: Expected fingerprints in a shard, above which more bits have to agree.
SHARD_TARGET = 256


def simhash(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the word shingles, repeats included."""
    words = raw.lower().split() if raw else []  # bytes.lower: A-Z; split: \x20 \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.zeros(len(words), np.int64)
    np.cumsum(sizes[:-1] + 1, out=starts[1:])
    stops = (starts + sizes)[shingle - 1 :]
    n = len(stops)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):  # bounded buffers for very long texts
        part = slice(at, min(n, at + (1 << 14)))
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(starts[part].tolist(), stops[part].tolist(), strict=True)
            ],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key, doc_id, fp): one row per document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(v.as_py(), shingle) for v in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64), pa.int64())],
                names=["key", "doc_id", "fp"],
            )

    rows = pick(docs, "doc_id", "text").select(
        row_key().alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("binary")
    )
    return long_rows(rows).mapInArrow(run, "key long, doc_id long, fp long")


# Shards ----------------------------------------------------------------------------


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ranges(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` consecutive ranges of the given bit positions."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def shard_masks(n: int, radius: int) -> list[int]:
    """Masks whose equality covers every pair within ``radius``.

    More ranges have to agree as the number of fingerprints grows, so that a shard of
    evenly spread fingerprints stays about as large at every size.
    """
    best: list[int] = []
    for agree in range(1, 5):
        parts = ranges(list(range(64)), radius + agree)
        best = [sum(c) for c in combinations(parts, agree)]
        least = min(m.bit_count() for m in best)
        if n / 2**least <= SHARD_TARGET:
            break
    return best


class Tree:
    """BK-tree over integers; a node is [value, {distance: child}]."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            d = (node[0] ^ value).bit_count()
            if d <= radius:
                found.append(node[0])
            low, high = d - radius, d + radius
            todo += [child for edge, child in node[1].items() if low <= edge <= high]
        return found


def forest(stored: list[int], asked: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Spanning edges of a shard's links; ``asked`` are the queries of another block."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    tree, edges = Tree(), []
    if asked is not None:
        for x in stored:
            tree.add(x)
    for x in stored if asked is None else asked:
        for y in tree.within(x, radius):
            a, b = find(x), find(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((x, y))
        if asked is None:
            tree.add(x)
    return edges


def shard_edges(shards: DataFrame, radius: int) -> DataFrame:
    """Edges of shards given as (k1, k2, k3, k4, block, other, side, fp).

    Rows of a shard arrive together and in order; a shard holds two blocks at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, ([], [])

        def flush() -> list[tuple[int, int]]:
            if len(rows[0]) + len(rows[1]) < 2:
                return []
            return forest(rows[0], rows[1] if key[4] != key[5] else None, radius)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys = np.stack([c.astype(np.int64) for c in cols[:6]], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            fps, side, out = cols[7].astype(np.int64).view(np.uint64), cols[6], []
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)], strict=True):
                if (now := tuple(keys[a].tolist())) != key:
                    if key is not None:
                        out += flush()
                    key, rows = now, ([], [])
                part, second = fps[a:z], side[a:z] == 1
                rows[0].extend(part[~second].tolist())
                rows[1].extend(part[second].tolist())
            yield edge_batch(out)
        if key is not None:
            yield edge_batch(flush())

    keys = ["k1", "k2", "k3", "k4", "block", "other"]
    return (
        shards.repartition(*keys)
        .sortWithinPartitions(*keys, "side", "fp")
        .select(*keys, "side", "fp")
        .mapInArrow(run, "a long, b long")
    )


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
    )


def links(fps: DataFrame, radius: int = RADIUS, most: int = MAX_SHARD) -> DataFrame:
    """(a, b): edges whose components equal those of all pairs within ``radius``.

    ``fps(fp)`` holds distinct fingerprints and is read three times: give it stored.
    """
    masks = shard_masks(fps.count(), radius)
    first = fps.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias(
            "k1", "k2"
        ),
    )
    sized = first.join(first.groupBy("k1", "k2").agg(F.count("*").alias("n")), ["k1", "k2"])
    sized = stage(sized.filter("n > 1"), "simhash-shards")
    small = sized.filter(F.col("n") <= most).select(
        "k1", "k2", F.lit(-1).alias("k3"), F.lit(0).cast("long").alias("k4"),
        F.lit(0).alias("block"), F.lit(0).alias("other"), F.lit(0).alias("side"), "fp",
    )
    # A shard too large for one tree: the bits it does not share are cut again.
    free = [[b for b in range(64) if not m >> b & 1] for m in masks]
    finer = F.array(
        *[
            F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in ranges(b, radius + 1)])
            for b in free
        ]
    )
    second = sized.filter(F.col("n") > most).select(
        "k1", "k2", "fp", F.posexplode(F.element_at(finer, F.col("k1") + 1)).alias("k3", "k4")
    )
    keys = ["k1", "k2", "k3", "k4"]
    again = second.join(second.groupBy(*keys).agg(F.count("*").alias("n")), keys)
    blocks = F.ceil(F.col("n") / most).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = again.filter("n > 1").select(
        *keys, "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("peer")
    )
    split = pairs.select(
        *keys,
        F.least("own", "peer").alias("block"),
        F.greatest("own", "peer").alias("other"),
        F.when(F.col("own") > F.col("peer"), 1).otherwise(0).alias("side"),
        "fp",
    )
    return shard_edges(small.unionByName(split), radius)


# Results ---------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, most: int = MAX_SHARD
) -> DataFrame:
    """(key, doc_id, fingerprint, component_id, root): one row per document.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` bits,
    ``root`` the fingerprint that names the component.
    """
    prints = stage(fingerprints(docs, shingle), "simhash-prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    edges = stage(links(nodes.select("fp"), radius, most), "simhash-links")
    roots = components(edges).withColumnRenamed("node", "fp")
    linked = stage(nodes.join(roots, "fp"), "simhash-linked")
    named = linked.join(linked.groupBy("root").agg(F.min("rep").alias("cid")), "root")
    labels = nodes.join(named.select("fp", "root", "cid"), "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("cid")).alias("component_id"),
    )
    return prints.join(labels, "fp").select(
        "key",
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id."""
    found = near_duplicates(docs)
    best = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return keep_rows(docs, best.groupBy("root").agg(F.min("key").alias("key")), once=True)
