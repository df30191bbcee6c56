"""Near-duplicates by SimHash with a segment-popcount embedding.

A fingerprint's 32 two-bit segments are mapped to their bit counts (0, 1 or 2). The Manhattan distance of two such
vectors never exceeds the fingerprints' Hamming distance, so it serves as a lower bound. Vectors within the radius
of three differ in three segments at most; with the segments in six groups, they agree on at least three whole
groups. So each of the 20 choices of three groups is a grid of unit cells, and every pair within the radius shares
a cell in one of them. Inside a cell the Manhattan bound goes first, then the exact Hamming test.

A count is kept in unary in its segment's two bits (00, 01, 11): the Manhattan distance is then the number of
differing bits.

Equal fingerprints are joined beforehand, so a group of exact copies is one point of the grid. A cell gives star
edges of its linked groups, not all its pairs: as many rows as it has points. A cell with more than `cell_rows`
points is dealt into blocks; every two blocks meet in a task of their own, so no cell is cut short or held whole.
Rows of a crowded cell, a frequent fingerprint or a large class learn its blocks or its class where they lie, from a
broadcast of at most 1,024 rows; only other keys' rows are shuffled by key.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other; a
text of fewer words than a shingle is one shingle. Rows with a null doc_id get their class's smallest known
doc_id, or null. Repeated rows each give a row. Empty tables give empty results. Only doc_id and text are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import cut, hot_from, look_up, map_batches, row_hash, utf8, whole_row
from gridlap.llm.components import connected_components

SEED, RADIUS, SHINGLE = 42, 3, 3
#: Words hashed at once; longer texts go on in further blocks.
BLOCK = 1 << 16
#: First bit and bit count of the six groups of segments.
GROUPS = ((0, 10), (10, 10), (20, 10), (30, 10), (40, 12), (52, 12))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: a bit is set if more than half of its shingles' hashes have it."""
    words = (text or b"").lower().split()  # of bytes: both keep to ASCII
    if not words:
        return 0
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for start in range(0, max(1, len(words) - shingle + 1), BLOCK):
        part = words[start : start + BLOCK + shingle - 1]
        shifted = [part[i:] for i in range(min(shingle, len(part)))]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*shifted, strict=False))), dtype=np.uint64)
        total += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), a row for each of docs."""

    def make():
        return lambda batch: {"doc_id": batch.column("doc_id"), "fp": [_signed(fingerprint(x, shingle)) for x in utf8(batch.column("text"))]}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, fp long")


def _counts(fp: Column) -> Column:
    """The two-bit segments' bit counts in unary."""
    low = F.lit(0x5555555555555555)
    half = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(half).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(half).bitwiseAND(low), 1))


def cells(points: DataFrame) -> DataFrame:
    """fp, cell: each fingerprint's cells in the 20 grids, as hashes; should two cells have one hash, they are tested as one."""
    masks = [_signed(sum(((1 << n) - 1) << at for at, n in keep)) for keep in combinations(GROUPS, 3)]
    own = F.array(*[F.xxhash64(F.lit(i), F.col("counts").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    return points.select("fp", _counts(F.col("fp")).alias("counts")).select("fp", F.explode(own).alias("cell"))


def _unary(fps: np.ndarray) -> np.ndarray:
    low = np.uint64(0x5555555555555555)
    half = fps >> np.uint64(1)
    return ((fps | half) & low) | ((fps & half & low) << np.uint64(1))


def _stars(fps: np.ndarray) -> list[tuple[int, int]]:
    """(fingerprint, first of its linked group) for all but each group's first."""
    n, counts, left, out = len(fps), _unary(fps), np.ones(len(fps), dtype=bool), []
    for first in range(n):
        if not left[first]:
            continue
        left[first] = False
        todo = [first]
        while todo:
            i = todo.pop()
            at = np.flatnonzero(left)
            at = at[np.bitwise_count(counts[at] ^ counts[i]) <= RADIUS]
            at = at[np.bitwise_count(fps[at] ^ fps[i]) <= RADIUS]
            left[at] = False
            todo.extend(at.tolist())
            out.extend((int(fps[j]), int(fps[first])) for j in at)
    return out


def links(points: DataFrame, cell_rows: int = 4096) -> DataFrame:
    """a, b: edges that connect all fingerprints of points (distinct, column fp) within the radius."""
    at = cut(cells(points))
    crowded = at.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    crowded = crowded.select("cell", "n", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks"))
    # A cell in n blocks is dealt out as pairs of blocks; the usual cell is the one pair (0, 0).
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = look_up(at, crowded, "cell", "n", hot_from(at.count())).select("fp", "cell", own.alias("own"), other.alias("other"))
    met = met.select("fp", F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("task"))
    met = met.repartition("task").sortWithinPartitions("task", "fp")
    return _runs(met).distinct()


def _runs(met: DataFrame) -> DataFrame:
    """Star edges of each run of equal tasks; runs may go over batches."""
    import pyarrow as pa

    def run(batches):
        task, fps = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

        def stars(task, fps):
            found = []
            edges = np.flatnonzero(np.diff(task)) + 1
            for s, e in zip([0, *edges], [*edges, len(task)], strict=True):
                if e - s > 1:
                    found += _stars(np.unique(fps[s:e]).view(np.uint64))
            a = np.array([x for x, _ in found], dtype=np.uint64).view(np.int64)
            b = np.array([x for _, x in found], dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            task = np.concatenate([task, batch.column("task").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column("fp").to_numpy(zero_copy_only=False)])
            last = int(np.searchsorted(task, task[-1])) if len(task) else 0  # the last run may go on
            if last:
                yield stars(task[:last], fps[:last])
                task, fps = task[last:], fps[last:]
        if len(task):
            yield stars(task, fps)

    return met.select("task", "fp").mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that chains of links reach."""
    return component_ids(cut(fingerprints(docs, shingle)), "fp", links)


def component_ids(prints: DataFrame, key: str, links) -> DataFrame:
    """doc_id, key, component_id for each row of prints (doc_id, key), which is a written table."""
    firsts = prints.groupBy(key).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    rooted = cut(components_of(prints.select(key).distinct(), key, links).join(firsts, key))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("points"))
    known = cut(look_up(rooted, least, "root", "points", hot_from(rooted.count())).select(key, "component_id", "n"))
    return look_up(prints, known, key, "n", hot_from(prints.count())).select("doc_id", key, "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs with one row of each class: that with the smallest doc_id, null last; of rows with one doc_id the first by
    fingerprint, then by a hash of all columns. Rows that are equal in all columns are one."""
    own = docs.select(F.col("doc_id").cast("long"), "text", row_hash(docs).alias("row"))

    def make():
        return lambda batch: {"doc_id": batch.column("doc_id"), "fp": [_signed(fingerprint(x, shingle)) for x in utf8(batch.column("text"))], "row": batch.column("row")}

    prints = cut(map_batches(own, make, "doc_id long, fp long, row long"))
    return first_of_classes(docs, prints, "fp", links)


def first_of_classes(docs: DataFrame, prints: DataFrame, key: str, links) -> DataFrame:
    """docs with the first row of each class of keys; prints: doc_id, key, row (its row_hash) for each row of docs.

    What tells the rows to keep from others is small: (doc_id, row) pairs. They meet the rows in one shuffle, which
    also brings equal rows together.
    """
    of_row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key, "row")
    rooted = components_of(prints.select(key).distinct(), key, links)
    firsts = prints.groupBy(key).agg(F.min(of_row).alias("first"))
    kept = firsts.join(rooted, key).groupBy("root").agg(F.min("first").alias("first")).select(F.coalesce("first.doc_id", F.lit(0)).alias("id"), F.col("first.row").alias("row"))
    placed = docs.select(whole_row(docs).alias("whole"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), row_hash(docs).alias("row"))
    return placed.join(kept, ["id", "row"], "left_semi").dropDuplicates(["id", "row"]).select("whole.*")


def components_of(points: DataFrame, key: str, links) -> DataFrame:
    """key, root of each of the distinct points; links makes the edges (a, b) between them."""
    points = cut(points)
    roots = connected_components(links(points)).withColumnRenamed("node", key)
    return points.join(roots, key, "left").select(key, F.coalesce("root", key).alias("root"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
