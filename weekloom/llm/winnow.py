"""Benchmark decontamination by winnowing.

Texts are words; from every run of ``window - K + 1`` consecutive k-grams the smallest
hash is kept (all of them on a tie). A span of ``window`` words that a document shares
with an item therefore shares a kept hash, whatever surrounds it. Kept hashes of the
documents are joined with those of the items, every match is extended to the windows
around it, and a window counts only where all of its words agree. An item of fewer words
is one window of its own length, for which every gram of that length is kept.

The join is a lookup in a broadcast index of at most ``MAX_INDEX_WORDS`` item words.
Larger benchmarks are cut into overlapping pieces that are dealt to several indexes, each
of which meets all documents; the hits of a document are merged afterwards.

Null and empty texts have no words: no hits. Repeated rows each get a row. An item with a
null id counts under the empty name, items that repeat an id count once. An empty
benchmark hits nothing, an empty document table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import (
    byte_view,
    keep_rows,
    long_rows,
    mix64,
    pick,
    row_key,
    slices,
    span_hashes,
)

WINDOW = 10
K = 5
MAX_INDEX_WORDS = 1_000_000
#: Words of an item in one piece; pieces overlap by a window less one word.
PIECE = 1000

WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("a") : ord("z") + 1] = WORD[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
STEP = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """Words of several texts laid end to end: hashes, and the text each belongs to."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray) -> None:
        data = LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = WORD[data]
        first = np.zeros(len(data) + 1, bool)  # a text starts here: no word goes across
        first[offsets] = True
        here, before = inside[1:], inside[:-1]
        starts = np.flatnonzero(here & (~before | first))
        stops = np.flatnonzero(before & (~here | first))
        self.hash = span_hashes(data, starts, stops)
        self.text = np.searchsorted(offsets, starts, "right") - 1
        self.first = np.searchsorted(starts, offsets[:-1])
        self.count = np.diff(np.append(self.first, len(starts)))

    def fits(self, size: int) -> np.ndarray:
        """Per start of a gram of ``size`` words: does it end in the same text?"""
        n = max(0, len(self.hash) - size + 1)
        return self.text[:n] == self.text[size - 1 : size - 1 + n]

    def grams(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        n = max(0, len(self.hash) - size + 1)
        out = np.zeros(n if at is None else len(at), np.uint64)
        for j in range(size):
            out = (out + (self.hash[j : j + n] if at is None else self.hash[at + j])) * STEP
        return mix64(out)


def winnowed(words: Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of kept k-grams, their hashes, per start: is it a whole window?)"""
    whole, grams = words.fits(window), words.grams(k)
    run, n = window - k + 1, len(whole)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), whole
    least = grams[:n].copy()
    for j in range(1, run):
        np.minimum(least, grams[j : j + n], out=least)
    kept = np.zeros(len(grams), bool)
    for j in range(run):
        kept[j : j + n] |= whole & (grams[j : j + n] == least)
    at = np.flatnonzero(kept)
    return at, grams[at], whole


def extend(at: np.ndarray, whole: np.ndarray, window: int, k: int) -> np.ndarray:
    """Starts of the whole windows that contain a k-gram starting at one of ``at``."""
    mark = np.zeros(len(whole), bool)
    for j in range(window - k + 1):
        back = at - j
        mark[back[(back >= 0) & (back < len(mark))]] = True
    return np.flatnonzero(mark & whole)


class Index:
    """Windows of some item pieces: kept hashes, the windows themselves, and their items."""

    def __init__(self, pieces: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.names, self.parts = sorted({name for name, _ in pieces}), {}
        ids = {name: i for i, name in enumerate(self.names)}
        raw = [text for _, text in pieces]
        offsets = np.cumsum([0, *map(len, raw)]).astype(np.int64)
        words = Words(offsets, np.frombuffer(b"".join(raw), np.uint8))
        item = np.array([ids[name] for name, _ in pieces], np.int64)
        for size in sorted({min(window, c) for c in words.count.tolist() if c}):
            k = K if size == window else size
            # The windows of this size: all of the long pieces, the whole of short ones.
            right = words.count >= window if size == window else words.count == size
            at, hashes, whole = winnowed(words, size, k)
            starts = np.flatnonzero(whole)
            starts = starts[right[words.text[starts]]]
            if not len(starts):
                continue
            windows, owner = words.grams(size, starts), item[words.text[starts]]
            order = np.lexsort((owner, windows))
            windows, owner, starts = windows[order], owner[order], starts[order]
            firsts = np.flatnonzero(np.append(True, windows[1:] != windows[:-1]))
            fps = np.unique(hashes[right[words.text[at]]])
            table = np.zeros(1 << 20, bool)
            table[(fps >> np.uint64(44)).astype(np.int64)] = True
            self.parts[size] = {
                "k": k,
                "fps": fps,
                "table": table,
                "windows": windows[firsts],
                "words": np.stack([words.hash[starts[firsts] + j] for j in range(size)], 1),
                "ptr": np.append(firsts, len(windows)),
                "owner": owner,
            }

    def match(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, int, dict]]:
        """(starts of matching windows, their numbers, window size, part) by size."""
        for size, part in self.parts.items():
            at, hashes, whole = winnowed(words, size, part["k"])
            near = part["table"][(hashes >> np.uint64(44)).astype(np.int64)]
            at, hashes = at[near], hashes[near]
            at = at[found(part["fps"], hashes) >= 0]
            starts = extend(at, whole, size, part["k"])
            number = found(part["windows"], words.grams(size, starts))
            starts, number = starts[number >= 0], number[number >= 0]
            same = np.ones(len(starts), bool)
            for j in range(size):
                same &= words.hash[starts + j] == part["words"][number, j]
            yield starts[same], number[same], size, part


def found(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Position of each value in a sorted table, -1 where it is absent."""
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1) if len(table) else np.full(len(values), -1)


def spans_of(marks: np.ndarray) -> list[list[int]]:
    """[start, stop) runs of a boolean array."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


def scan(index: Index, batch: pa.RecordBatch) -> tuple[list, list, list]:
    """Per text of the batch's last column: words, hit word spans, names of hit items."""
    words = Words(*byte_view(batch.column(batch.num_columns - 1)))
    marks = np.zeros(len(words.hash), bool)
    items: dict[int, set[int]] = {}
    for starts, number, size, part in index.match(words):
        for j in range(size):
            marks[starts + j] = True
        text = words.text[starts]
        turns = (np.flatnonzero(text[1:] != text[:-1]) + 1).tolist()
        edges = [0, *turns, len(text)] if len(text) else []
        for a, z in zip(edges, edges[1:], strict=False):
            own = items.setdefault(int(text[a]), set())
            for w in np.unique(number[a:z]):
                own.update(part["owner"][part["ptr"][w] : part["ptr"][w + 1]].tolist())
    spans: list[list] = [[] for _ in range(batch.num_rows)]
    for i in items:
        f = words.first[i]
        spans[i] = spans_of(marks[f : f + words.count[i]])
    names = [[index.names[j] for j in sorted(items.get(i, ()))] for i in range(batch.num_rows)]
    return words.count.tolist(), spans, names


def item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(name, words, piece): items cut to bounded pieces that lose no window."""
    upper = "".join(map(chr, range(65, 91)))
    lower = F.translate("text", upper, upper.lower())
    # The words of the contract: no control, punctuation or upper-case ASCII character.
    pattern = F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
    words = F.regexp_extract_all(lower, pattern, F.lit(1))
    cut = pick(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), words.alias("words")
    )
    last = F.greatest(F.lit(0), F.floor((F.size("words") - window) / PIECE))
    return cut.filter(F.size("words") > 0).select(
        "name", "words", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("piece")
    ).select(
        "name",
        F.expr(f"slice(words, piece * {PIECE} + 1, {PIECE + window - 1})").alias("words"),
    )


def hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_INDEX_WORDS
) -> DataFrame:
    """(key, doc_id, n_words, spans, items): hit word ranges and items of each document."""
    spark = docs.sparkSession
    pieces = item_pieces(benchmark, window).withColumn("n", F.size("words")).cache()
    total = pieces.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-2 * total // most) if total > most else 1)
    rows = pick(docs, "doc_id", "text").select(
        row_key().alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("binary")
    )
    schema = (
        "key long, doc_id long, n_words long, spans array<array<int>>, "
        "items array<string>, part int"
    )
    out = None
    for p in range(parts):
        own = pieces.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == p)
        # Bounded: an index holds ``most`` words or, when dealt by hash, about half of it.
        listed = [(r[0], " ".join(r[1]).encode()) for r in own.select("name", "words").collect()]
        index = spark.sparkContext.broadcast(Index(listed, window))

        def run(batches, index=index, p=p):
            for whole in batches:
                for batch in slices(whole, 2):
                    n, spans, names = scan(index.value, batch)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0),
                            batch.column(1),
                            pa.array(n, pa.int64()),
                            pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                            pa.array(names, pa.list_(pa.string())),
                            pa.array([p] * len(n), pa.int32()),
                        ],
                        names=["key", "doc_id", "n_words", "spans", "items", "part"],
                    )

        found_in = long_rows(rows).mapInArrow(run, schema)
        if p:
            found_in = found_in.filter(F.size("spans") > 0)
        out = found_in if out is None else out.unionByName(found_in)
    pieces.unpersist()
    if parts == 1:
        return out.drop("part")
    merged = out.groupBy("key", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),  # one list of each index at most
        F.flatten(F.collect_list("items")).alias("items"),
        F.count(F.when(F.col("part") == 0, 1)).cast("int").alias("copies"),
    )
    return merged.select(
        "key", "doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), "copies"))
    ).drop("col")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_INDEX_WORDS
) -> DataFrame:
    """(key, doc_id, n_words, n_hit, n_items, items, contaminated) of each document."""
    # Spans of repeated rows and of several indexes may overlap: count their union.
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x[1] - F.greatest(x[0], s["end"]))).alias("n"),
            F.greatest(s["end"], x[1]).alias("end"),
        ),
        lambda s: s["n"].cast("long"),
    )
    return hits(docs, benchmark, window, most).select(
        "key",
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    ).select(
        "key",
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that share a window with the benchmark."""
    clean = contamination(docs, benchmark).filter("NOT contaminated")
    return keep_rows(docs, clean.select("key").distinct())
