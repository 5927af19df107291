"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

A text's terms are its lower-cased letter runs, all of them. The labelled examples are an
inverted index over every term they hold; no term is chosen and none is left out, so any
text that shares a term with an example meets it. A term weighs its logarithmic frequency
times its inverse document frequency, counted on the whole corpus, times the square root
of its log-likelihood ratio between the two classes of examples: plain TF-IDF finds texts
on one subject, and a few insults among hundreds of words do not make a subject (36 of 97
held-out toxic documents, with the ratio 89).

Posting lists are cut in blocks with their largest weight. The lists of a text's rarer terms
are summed first; blocks of examples whose sums and largest weights cannot reach the k-th
best cosine are skipped, the others are finished exactly.

The vote is the similarity-weighted share of toxic neighbours, shrunk to their base rate by
``SHRINK``. An isotonic fit on the votes of the examples themselves, each without itself,
turns votes into probabilities; it needs ``CALIBRATED`` examples of each class. Labels are
read from at most ``MAX_EXAMPLES`` documents of each class (those of the smallest hash, of
at most ``MAX_CHARS`` characters together) whose crc32(doc_id) mod 5 is not 0, so the index
that is broadcast has a fixed bound.

Null and empty texts, and those that share no term with an example, get the base rate.
Repeated rows each get a row; a document with conflicting labels counts as toxic; labels
of unknown documents are ignored. Without labels of both classes there is no index, and the
score is 0 without toxic and 0.5 or less without clean ones. An empty table gives no rows,
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm.common import keep_rows, long_rows, pick, row_key, slices
from weekloom.sources.staging import stage

MAX_EXAMPLES = 2_000
MAX_CHARS = 50_000_000
NEIGHBOURS = 15
BLOCK = 64
#: Terms that more than one example in so many holds have their list as a row of a matrix.
DENSE = 16
#: Texts that are looked up together.
GROUP = 32
#: Weight of the base rate in a vote, in units of cosine.
SHRINK = 0.1
#: Added to log-likelihood ratios: no term weighs nothing.
FLOOR = 0.01
#: Examples of each class below which votes stay as they are.
CALIBRATED = 20
HELD_OUT = 5
#: Documents a task votes on.
ROWS = 4096
TERM = re.compile(r"[^\W\d_]{1,40}")


def terms(text: str | None) -> Counter:
    return Counter(TERM.findall(text.lower() if text else ""))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT == 0, F.lit(False))


# Examples --------------------------------------------------------------------------


def clean_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the documents whose labels may be read."""
    return (
        pick(labels, "doc_id", "toxic")
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )


def sample_labels(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` documents of each class of ``clean_labels``."""
    hashed = labels.withColumn("h", F.xxhash64("doc_id"))
    parts = [hashed.filter(F.col("toxic") == t).orderBy("h", "doc_id").limit(most) for t in (0, 1)]
    return parts[0].unionByName(parts[1])


def example_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text, toxic): one row a different text, of bounded length together."""
    rows = pick(docs, "doc_id", "text").filter("text <> ''")
    # At most 2 * MAX_EXAMPLES labels: a bounded broadcast. Copies are one example.
    texts = (
        rows.join(F.broadcast(known), "doc_id")
        .groupBy("text")
        .agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    )
    # All in one task: as many rows as labels were sampled, of numbers only.
    sizes = texts.select("doc_id", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "h"))
    fits = sizes.withColumn("upto", upto).filter(F.col("upto") <= MAX_CHARS)
    return texts.join(fits.select("doc_id", "h"), [texts.doc_id == fits.doc_id, F.xxhash64("text") == fits.h], "left_semi")


def counted_terms(texts: DataFrame) -> DataFrame:
    """(doc_id, toxic, terms, counts) of examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                found = [terms(decoded(v.as_py())) for v in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array([list(f) for f in found], pa.list_(pa.string())),
                        pa.array([list(f.values()) for f in found], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "toxic", "terms", "counts"],
                )

    rows = texts.select(F.col("doc_id").cast("long"), "toxic", F.col("text").cast("binary"))
    return long_rows(rows).mapInArrow(run, "doc_id long, toxic int, terms array<string>, counts array<int>")


def hash_of(words: pa.ListScalar) -> int:
    """A number that texts of equal documents differ by, whatever the partitioning."""
    return zlib.crc32("\n".join(sorted(words.as_py())).encode())


def decoded(raw: bytes | None) -> str | None:
    return None if raw is None else raw.decode("utf-8", "replace")


def vectors(docs: DataFrame, words: pa.Array) -> DataFrame:
    """(key, doc_id, ids, counts): counts of every document's terms that examples hold.

    ``words`` are the terms of the examples, in the order of their numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(shared.value.to_pylist())}
        for whole in batches:
            for batch in slices(whole, 2):
                ids: list[int] = []
                counts: list[int] = []
                cuts = [0]
                for v in batch.column(2):
                    own = terms(decoded(v.as_py())) if known else {}
                    own = sorted((known[w], n) for w, n in own.items() if w in known)
                    ids += [i for i, _ in own]
                    counts += [n for _, n in own]
                    cuts.append(len(ids))
                places = pa.array(cuts, pa.int32())
                lists = [
                    pa.ListArray.from_arrays(places, pa.array(x, pa.int32())) for x in (ids, counts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *lists], names=["key", "doc_id", "ids", "counts"]
                )

    rows = pick(docs, "doc_id", "text").select(
        row_key().alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("binary")
    )
    return long_rows(rows).mapInArrow(run, "key long, doc_id long, ids array<int>, counts array<int>")


# Index -----------------------------------------------------------------------------


def class_weights(ids: np.ndarray, owner: np.ndarray, toxic: np.ndarray, n: int) -> np.ndarray:
    """Per term, the square root of its log-likelihood ratio between the classes."""
    bad, good = toxic.sum(), len(toxic) - toxic.sum()
    t = np.bincount(ids, toxic[owner], n)
    c = np.bincount(ids, 1 - toxic[owner], n)

    def part(a: np.ndarray, whole: float) -> np.ndarray:
        expected = np.maximum((t + c) * whole / max(len(toxic), 1), 1e-12)
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / expected), 0.0)

    return np.sqrt(np.maximum(2 * (part(t, bad) + part(c, good)), 0) + FLOOR)


class Examples:
    """Block-max inverted index over the labelled examples.

    ``ids`` and ``counts`` are the terms of all examples laid end to end, ``cuts`` where each
    begins, ``scale`` is the weight of each term. Examples lie in blocks of ``BLOCK``. Lists
    of rarer terms are (example, weight) pairs; those of terms that more than one example in
    ``DENSE`` holds are rows of a matrix, each with its largest weight in every block. The
    lists are made where the index is first asked.
    """

    def __init__(
        self,
        doc: list,
        toxic: np.ndarray,
        cuts: np.ndarray,
        ids: np.ndarray,
        counts: np.ndarray,
        scale: np.ndarray,
        base: float,
    ) -> None:
        self.doc, self.toxic, self.cuts = doc, toxic, cuts
        self.ids, self.counts, self.scale, self.base = ids, counts, scale, base
        self.matrix: np.ndarray | None = None

    def __getstate__(self) -> dict:
        """What travels: the texts of the examples as numbers, not the lists made of them."""
        names = ("doc", "toxic", "cuts", "ids", "counts", "scale", "base")
        return {n: getattr(self, n) for n in names}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, matrix=None)

    def build(self) -> None:
        rows = len(self.doc)
        n = -(-max(rows, 1) // BLOCK) * BLOCK
        ids, owner = self.ids, np.repeat(np.arange(rows), np.diff(self.cuts))
        w = self.weigh(ids, self.counts, owner, rows)
        often = np.flatnonzero(np.bincount(ids, minlength=len(self.scale)) * DENSE > rows)
        self.row = np.full(len(self.scale), -1)
        self.row[often] = np.arange(len(often))
        head = self.row[ids] >= 0
        self.matrix = np.zeros((len(often), n))
        self.matrix[self.row[ids[head]], owner[head]] = w[head]
        self.top = self.matrix.reshape(len(often), n // BLOCK, BLOCK).max(axis=2)
        ids, owner, w = ids[~head], owner[~head], w[~head]
        order = np.argsort(ids, kind="stable")
        self.at, self.w = owner[order], w[order]
        self.first = np.searchsorted(ids[order], np.arange(len(self.scale) + 1))

    def text(self, j: int) -> tuple[list[int], list[int]]:
        """(ids, counts) of an example."""
        own = slice(self.cuts[j], self.cuts[j + 1])
        return self.ids[own].tolist(), self.counts[own].tolist()

    def weigh(self, ids: np.ndarray, counts: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Weights of the terms of ``n`` texts laid end to end, of unit length in each."""
        w = (1 + np.log(counts)) * self.scale[ids]
        squares = np.bincount(owner, w * w, n)
        return w / np.sqrt(np.maximum(squares, 1e-300))[owner]

    def nearest(self, texts: list[tuple], k: int = NEIGHBOURS) -> list[list[tuple]]:
        """Per text (ids, counts) the (cosine, example) of its k nearest, exactly.

        Ties go to the lower example. The rarer terms of all texts are gathered first: the
        k-th best sum is a bar that the final one cannot fall below. A block of examples is
        left out where its best sum and its largest weights do not reach the bar; what is
        left is finished with the matrix, block by block for the texts that need it.
        """
        if self.matrix is None:
            self.build()
        n, width = len(texts), self.matrix.shape[1]
        sizes = [len(i) for i, _ in texts]
        ids = np.array([i for own, _ in texts for i in own], np.int64)
        counts = np.array([c for _, own in texts for c in own], float)
        owner = np.repeat(np.arange(n), sizes)
        q = self.weigh(ids, counts, owner, n)
        row = self.row[ids]
        head = row >= 0
        dense = np.zeros((n, len(self.matrix)))
        dense[owner[head], row[head]] = q[head]
        begin = self.first[ids]
        count = self.first[ids + 1] - begin
        upto = np.cumsum(count)
        at = np.repeat(begin - (upto - count), count) + np.arange(count.sum())
        place = np.repeat(owner * width, count) + self.at[at]
        sums = np.bincount(place, np.repeat(q, count) * self.w[at], n * width)
        got = sums.astype(float, copy=False).reshape(n, width)
        bar = np.partition(got, -k, axis=1)[:, -k] if width > k else np.zeros(n)
        reach = got.reshape(n, width // BLOCK, BLOCK).max(axis=2) + dense @ self.top
        need = reach + 1e-9 >= bar[:, None]
        for block in np.flatnonzero(need.any(axis=0)).tolist():
            own, part = np.flatnonzero(need[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
            got[own, part] += dense[own] @ self.matrix[:, part]
        got.reshape(n, width // BLOCK, BLOCK)[~need] = 0.0
        last = np.partition(got, -k, axis=1)[:, -k] if width > k else np.zeros(n)
        out = []
        for scores, bound in zip(got, last.tolist(), strict=True):
            near = np.flatnonzero((scores > 0) & (scores >= bound - 1e-9))
            chosen = near[np.lexsort((near, -np.round(scores[near], 12)))][:k]
            out.append([(float(scores[j]), int(j)) for j in chosen])
        return out

    def votes(self, texts: list[tuple], but: list[int] | None = None) -> list[tuple]:
        """Per text (share of toxic neighbours, their documents), without example ``but``."""
        out = []
        for start in range(0, len(texts), GROUP):
            group = texts[start : start + GROUP]
            found = self.nearest(group, NEIGHBOURS + (but is not None))
            for n, near in enumerate(found, start):
                near = [(s, j) for s, j in near if but is None or j != but[n]][:NEIGHBOURS]
                mass = sum(s for s, _ in near)
                toxic = sum(s * self.toxic[j] for s, j in near)
                share = (toxic + SHRINK * self.base) / (mass + SHRINK)
                out.append((share, [self.doc[j] for _, j in near]))
        return out


def calibration(spark: SparkSession, shared: Broadcast, weights: list[float]) -> list:
    """(votes, probabilities): an isotonic fit on the examples, each voted on by the others.

    ``shared`` holds the index; ``weights`` restore the share of either class.
    """
    # Only the driver fits: workers import this module too and need none of its 26 MB.
    from pyspark.ml.regression import IsotonicRegression

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            own = batch.column(0).to_pylist()
            votes = [v for v, _ in index.votes([index.text(j) for j in own], own)]
            labels = [float(index.toxic[j]) for j in own]
            part = [weights[index.toxic[j]] for j in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.float64()) for x in (votes, labels, part)],
                names=["vote", "label", "weight"],
            )

    n = len(shared.value.doc)
    votes = spark.range(0, n, 1, n // 512 + 1)
    votes = votes.mapInArrow(run, "vote double, label double, weight double")
    model = IsotonicRegression(featuresCol="vote", weightCol="weight").fit(
        stage(votes, "toxicity-votes").orderBy("vote", "label")
    )
    return [model.boundaries.toArray(), model.predictions.toArray()]


# Results ---------------------------------------------------------------------------


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """(key, doc_id, held_out, score, predicted, evidence): one row per document.

    ``evidence`` lists the ids of the nearest labelled examples, nearest first.
    """
    spark = docs.sparkSession
    every = stage(clean_labels(labels), "toxicity-labels")
    texts = example_texts(docs, sample_labels(every, most).select("doc_id", "toxic"))
    found = counted_terms(texts).toArrow()  # bounded by the sample, as everything up to the index
    order = [("doc_id", "ascending"), ("h", "ascending")]  # ties of cosine go to the lower document
    found = found.append_column("h", pa.array([hash_of(t) for t in found["terms"]])).sort_by(order)
    marks = found["toxic"].to_numpy()
    both = 0 in marks and 1 in marks
    if not both:
        found = found.slice(0, 0)
    listed = found["terms"].combine_chunks()
    held = listed.flatten().cast(pa.string())
    words = held.unique().sort()
    ids = pc.index_in(held, words).to_numpy(zero_copy_only=False).astype(np.int32)
    counts = found["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
    counted = stage(vectors(docs, words), "toxicity-vectors")
    total, df = counted.count(), np.zeros(len(words))
    # At most one row for each term of the examples.
    often = counted.select(F.explode("ids").alias("i")).groupBy("i").count().toArrow()
    df[often["i"].to_numpy()] = often["count"].to_numpy()
    rates = {r.toxic: r["count"] for r in every.groupBy("toxic").count().collect()}
    base = rates.get(1, 0) / max(sum(rates.values()), 1)
    owner, toxic = np.repeat(np.arange(len(found)), sizes), found["toxic"].to_numpy().astype(np.int8)
    scale = (np.log((1 + total) / (1 + df)) + 1) * class_weights(ids, owner, toxic, len(words))
    cuts = np.append(0, np.cumsum(sizes)).astype(np.int64)
    base = base if both else min(base, 0.49)
    index = Examples(found["doc_id"].to_pylist(), toxic, cuts, ids, counts, scale, base)
    shared = spark.sparkContext.broadcast(index)
    at, chance = np.zeros(0), np.zeros(0)
    sampled = np.bincount(marks, minlength=2)
    if sampled.min() >= CALIBRATED:
        weights = [rates[c] / int(sampled[c]) for c in (0, 1)]
        at, chance = calibration(spark, shared, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids, counts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            votes = index.votes(list(zip(ids, counts, strict=True)))
            score = np.array([v[0] for v in votes], float)
            alone = np.array([not v[1] for v in votes], bool)
            if len(at):
                score = np.where(alone, score, np.interp(score, at, chance))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score, pa.float64()),
                    pa.array([v[1] for v in votes], pa.list_(pa.int64())),
                ],
                names=["key", "doc_id", "score", "evidence"],
            )

    # Files of vectors are small and few: dealt over tasks by rows.
    spread = counted.repartition(total // ROWS + 1)
    scored = spread.mapInArrow(run, "key long, doc_id long, score double, evidence array<long>")
    return scored.select(
        "key",
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic."""
    good = toxicity(docs, labels).filter("predicted = 0")
    return keep_rows(docs, good.select("key").distinct())
