"""Near copies for the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from SimHash fingerprints and the grid join of `simhash`. At 0.8 some 15 % of a whole text's bits differ, too
many for a grid to meet on, so a text has several fingerprints: its shingles are dealt by their hashes into 32 classes
(of a long text a share of the shingles: those whose hash begins with as many zeros as leave 5 or fewer a class), and each
class that isn't empty has a fingerprint. Its segments' bit counts are a projection of the text's vector, and their unit cell
is a cell of the grid. Two texts meet if one class is the same in both: all classes that aren't empty differ with a chance of
3 in a million at 0.8 for the least favourable size, less for others. Shares halve from level to level; a text also has
the cells of the next level if one with 5/4 of its shingles would be there, and no similar text is longer.

Inside a cell whole texts are compared by 256 bits of SimHash: first the Manhattan bound on segments' bit counts, then the Hamming
distance. More than 80 bits differ with a chance of under 1 in a million at 0.8, whatever the size (a bit differs with 0.19
at most, between four shingles and five). The components of what is left are coarse groups, and all candidate
pairs lie inside one. Each group's texts then meet once, and their shingle sets are compared exactly: only true pairs are linked.

Equal texts are one point. A cell with more than `cell_rows` points is dealt into blocks, every two of which meet in a task
of their own. A group with more than `group_bytes` of text is dealt into blocks as well, of which only what isn't yet
joined to the group's largest class meets the others (see _large_groups). None is cut short or held whole. A text that
1 in 1,024 rows have is read from the rows with its smallest doc_id only; no join gathers the rows of such a text, cell
or group in one task.

Defined cases: words are as in `simhash` (A-Z lowered, ASCII white space); a text of fewer than five words is one
shingle; null, empty and wordless texts are copies of one another. Points are told apart by a 64-bit hash of the text.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlap.llm import simhash
from gridlap.llm.common import SPACES, cut, hot_from, look_up, row_hash, utf8
from gridlap.llm.components import connected_components
from gridlap.llm.simhash import _unary

SEED, SHINGLE = 42, 5
#: Classes of a text's shingles, as a power of two, and the most shingles a class has on average.
CLASS_BITS, CLASS_SIZE = 5, 5
#: Longs of a whole text's fingerprint, and the differing bits within which texts are candidates.
WORDS, REACH = 4, 80
PRINTS = [f"p{i}" for i in range(WORDS)]
#: Texts of a large group that all its blocks are compared with.
SHOWN_TO_ALL = 16
#: The similarity to link, as a fraction: 4 / 5.
PART, WHOLE = 4, 5
#: What is added to a hash before it is mixed: for each long of the fingerprint, and for the classes.
_ADDED = np.random.default_rng(SEED).integers(0, 1 << 63, WORDS + 1, dtype=np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    """The hashes of a text's shingles, in order of the text."""
    words = (text or b"").lower().split()  # of bytes: both keep to ASCII
    shifted = [words[i:] for i in range(min(SHINGLE, len(words)))]
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*shifted, strict=False))), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """A row of bits for each row of hashes."""
    return np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")


def whole_print(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of a set of shingles in WORDS longs."""
    ones = np.zeros(64 * WORDS, dtype=np.int64)
    for start in range(0, len(hashes), 255):  # as many as a byte can count
        ones += _bits(_mixed(hashes[start : start + 255, None] + _ADDED[None, :WORDS])).sum(axis=0, dtype=np.uint8)
    return np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)


def _level(n: int) -> int:
    """How often the shingles are halved so that a class has no more than CLASS_SIZE."""
    return max(0, (-(-n // (CLASS_SIZE << CLASS_BITS)) - 1).bit_length())


def grid_cells(hashes: np.ndarray) -> np.ndarray:
    """The cells of a set of shingles: for each class, the bit counts of its fingerprint's segments."""
    n, found, mixed = len(hashes), [], _mixed(hashes + _ADDED[WORDS])
    for level in sorted({_level(n), _level(n * WHOLE // PART)}):
        classes = mixed >> np.uint64(64 - CLASS_BITS - level)  # those that begin with `level` zeros are below 32
        at = np.flatnonzero(classes < 1 << CLASS_BITS)
        if not len(at):
            continue
        at = at[np.argsort(classes[at], kind="stable")]
        classes = classes[at]
        starts = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        ones = np.add.reduceat(_bits(hashes[at]), starts, axis=0, dtype=np.int64)
        size = np.diff(np.append(starts, len(at)))
        prints = np.packbits((2 * ones > size[:, None]).astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()
        found.append(_mixed(_unary(prints) + _mixed(np.uint64(level << CLASS_BITS) + classes[starts])))
    return np.concatenate(found).view(np.int64) if found else np.empty(0, dtype=np.int64)


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.btrim("text", F.lit(SPACES)), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key of each row, written."""
    return cut(docs.select(F.col("doc_id").cast("long"), text_key().alias("key")))


def sparse(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """key, text: all rows of docs but those of a hot text that haven't its smallest doc_id; prints: doc_id, key of docs' rows.

    There are as many hot texts as hot_from lets be, at most 1,024.
    """
    hot = prints.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where(F.col("n") >= hot_from(prints.count()))
    own = docs.select(text_key().alias("key"), F.col("doc_id").cast("long").alias("id"), "text")
    return own.join(F.broadcast(hot), "key", "left").where(F.col("n").isNull() | F.col("id").eqNullSafe(F.col("first"))).select("key", "text")


def cells(texts: DataFrame) -> DataFrame:
    """key, p0 to p3 (the fingerprint), cell: the cells of each text with words; equal keys of a task come once."""
    import pyarrow as pa

    def run(batches):
        for batch in _once(batches):
            sets = [(k, np.unique(h)) for k, t in zip(batch.column("key").to_pylist(), utf8(batch.column("text")), strict=True) if len(h := shingles(t))]
            own = [grid_cells(h) for _, h in sets]
            times = np.array([len(c) for c in own], dtype=np.int64)
            key = np.repeat(np.array([k for k, _ in sets], dtype=np.int64), times)
            prints = np.repeat(np.array([whole_print(h) for _, h in sets], dtype=np.int64).reshape(-1, WORDS), times, axis=0)
            cell = np.concatenate([np.empty(0, dtype=np.int64), *own])
            yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(np.ascontiguousarray(p)) for p in prints.T), pa.array(cell)], names=["key", *PRINTS, "cell"])

    return texts.mapInArrow(run, f"key long, {', '.join(f'{p} long' for p in PRINTS)}, cell long")


def _once(batches):
    """The batches without keys that the task has had; what it remembers is bounded."""
    import pyarrow as pa

    had: set[int] = set()
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch, new = whole.slice(start, 1024), []
            if len(had) > 1 << 20:
                had.clear()
            for i, k in enumerate(batch.column("key").to_pylist()):
                if k not in had:
                    had.add(k)
                    new.append(i)
            yield batch.take(pa.array(new, pa.int64()))


def _near_bits(keys: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
    """(key, first of its linked group) for all but each group's first, by the Manhattan bound and the fingerprints (a row a word)."""
    keys, at = np.unique(keys, return_index=True)
    prints = np.ascontiguousarray(prints[:, at]).view(np.uint64)
    counts, rest, out = _unary(prints), np.arange(len(keys)), []

    def within(table, i, of):
        return sum(np.bitwise_count(word[of] ^ word[i]).astype(np.int16) for word in table) <= REACH

    while len(rest):
        first, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            near = within(counts, i, rest)
            near[near] = within(prints, i, rest[near])
            found, rest = rest[near], rest[~near]
            todo.extend(found.tolist())
            out.extend((int(keys[j]), int(keys[first])) for j in found)
    return out


def similar(keys: np.ndarray, texts: list[bytes | None]) -> list[tuple[int, int]]:
    """(key, first of its linked group) for all but each group's first, by the exact similarity."""
    keys, at = np.unique(keys, return_index=True)
    sets = [np.unique(shingles(texts[i])) for i in at]
    order = np.argsort([len(s) for s in sets], kind="stable")
    keys, sets = keys[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark, left, out = np.zeros(len(ids), dtype=bool), np.ones(len(keys), dtype=bool), []
    for first in range(len(keys)):
        if not left[first]:
            continue
        left[first] = False
        todo = [first]
        while todo:
            i = todo.pop()
            # The smaller set has at least 4/5 of the larger one's size.
            lo = np.searchsorted(sizes, -(-PART * sizes[i] // WHOLE))
            hi = np.searchsorted(sizes, WHOLE * sizes[i] // PART, side="right")
            at = lo + np.flatnonzero(left[lo:hi])
            if not len(at):
                continue
            mark[ids[starts[i] : ends[i]]] = True
            if 4 * len(at) >= hi - lo:
                common = np.add.reduceat(mark[ids[starts[lo] : ends[hi - 1]]], starts[lo:hi] - starts[lo], dtype=np.int64)[at - lo]
            else:
                common = np.array([np.count_nonzero(mark[ids[starts[j] : ends[j]]]) for j in at])
            mark[ids[starts[i] : ends[i]]] = False
            at = at[(PART + WHOLE) * common >= PART * (sizes[at] + sizes[i])]
            left[at] = False
            todo.extend(at.tolist())
            out.extend((int(keys[j]), int(keys[first])) for j in at)
    return out


def _met(rows: DataFrame, group: str, blocks: DataFrame) -> DataFrame:
    """rows (a written table) with a task for each pair of blocks of their group, ordered by task; blocks: group, n (its rows), blocks."""
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = look_up(rows, blocks, group, "n", hot_from(rows.count())).select(*rows.columns, own.alias("own"), other.alias("other"))
    task = F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(task.alias("task"), *[c for c in rows.columns if c != group]).repartition("task").sortWithinPartitions("task")


def _runs(met: DataFrame, stars) -> DataFrame:
    """a, b: what stars(columns but task) gives for each run of equal tasks; runs may go over batches."""
    import pyarrow as pa

    def edges(table):
        found, task = [], table.column("task").to_numpy()
        at = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), len(task)]
        for s, e in zip(at, at[1:], strict=False):
            if e - s > 1:
                found += stars(table.slice(s, e - s))
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    def run(batches):
        held = []  # batches that end in one open run
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column("task").to_numpy()
            last = int(np.flatnonzero(task != task[-1])[-1]) + 1 if task[0] != task[-1] else 0
            if last or (held and held[-1].column("task")[-1].as_py() != task[0]):
                # Rows before the batch's last run end all that is held.
                yield edges(pa.Table.from_batches([*held, batch.slice(0, last)] if last else held))
                held = []
            held.append(batch.slice(last))
        if held:
            yield edges(pa.Table.from_batches(held))

    return met.mapInArrow(run, "a long, b long").distinct()


def coarse_groups(texts: DataFrame, cell_rows: int = 4096) -> DataFrame:
    """key, root: the components of the candidate pairs."""
    at = cut(cells(texts))
    crowded = at.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / cell_rows).cast("int"))

    def stars(t):
        return _near_bits(t.column("key").to_numpy(), np.stack([t.column(p).to_numpy() for p in PRINTS]))

    return connected_components(_runs(_met(at, "cell", crowded), stars)).withColumnRenamed("node", "key")


def links(docs: DataFrame, prints: DataFrame, cell_rows: int = 4096, group_bytes: int = 1 << 21) -> DataFrame:
    """a, b: edges that connect all keys of texts with a similarity of 0.8 or more; prints: doc_id, key of docs' rows, a written table."""
    texts = sparse(docs, prints)
    once = texts.mapInArrow(_once, "key long, text string")
    held = cut(once.join(coarse_groups(texts, cell_rows), "key").dropDuplicates(["key"]))
    blocks = cut(held.groupBy("root").agg(F.ceil(F.sum(F.octet_length("text")) / group_bytes).cast("int").alias("blocks"), F.count("*").alias("n")))
    large = blocks.where("blocks > 1")
    if large.isEmpty():
        return _compared(held, F.col("root"))
    least = hot_from(held.count())
    largest = F.broadcast(large.where(F.col("n") >= least))
    small = _compared(held.join(largest, "root", "left_anti").join(large.where(F.col("n") < least), "root", "left_anti"), F.col("root"))
    return small.unionByName(_large_groups(look_up(held, large.withColumn("rows", F.col("n")), "root", "n", least), least, group_bytes))


def _compared(rows: DataFrame, *task: Column) -> DataFrame:
    """Edges between the similar texts of rows (key, text) that have the same task."""

    def stars(t):
        return similar(t.column("key").to_numpy(), utf8(t.column("text")))

    return _runs(rows.select(F.xxhash64(*task).alias("task"), "key", "text").repartition("task").sortWithinPartitions("task"), stars)


def _large_groups(rows: DataFrame, least: int, group_bytes: int) -> DataFrame:
    """Edges of groups that are dealt into blocks; rows: key, text, root, blocks, rows (of the group; hot from `least`).

    First each block is compared within itself and with a few of its group's texts. What these join into the group's largest
    class needs no further comparison inside it, so only the rest, itself in blocks, meets all blocks: a group of copies
    of one text moves its bytes some two or three times, however large it is.
    """
    rows = cut(rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))
    first_few = rows.select("root", "key").withColumn("n", F.row_number().over(Window.partitionBy("root").orderBy("key"))).where(F.col("n") <= SHOWN_TO_ALL)
    shown = rows.join(first_few.select("key"), "key", "left_semi").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    edges = cut(_compared(rows.unionByName(shown), F.col("root"), F.col("block")))
    classes_ = connected_components(edges).select(F.col("node").alias("key"), F.col("root").alias("class"))
    placed = cut(rows.select("root", "rows", "key", F.octet_length("text").alias("bytes")).join(classes_, "key", "left").withColumn("class", F.coalesce("class", "key")))
    sizes = placed.groupBy("root", "class").agg(F.sum("bytes").alias("bytes"), F.first("rows").alias("n"))
    largest = sizes.groupBy("root").agg(F.max_by("class", F.struct("bytes", "class")).alias("largest"), F.first("n").alias("n"))
    rest = cut(look_up(placed, largest, "root", "n", least).where(F.col("class") != F.col("largest")).select("root", "rows", "key", "bytes"))
    parts = rest.groupBy("root").agg(F.ceil(F.sum("bytes") / group_bytes).cast("int").alias("parts"), F.first("rows").alias("n"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    of_rest = look_up(rows.join(rest.select("key"), "key", "left_semi"), parts, "root", "n", least).withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int")).withColumn("block", every(F.col("blocks")))
    of_all = look_up(rows, parts, "root", "n", least).withColumn("part", every(F.col("parts")))
    return edges.unionByName(_compared(of_rest.unionByName(of_all), F.col("root"), F.col("block"), F.col("part")))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, key, component_id: the smallest doc_id that chains of links reach; a row for each of docs."""
    prints = keyed(docs)
    return simhash.component_ids(prints, "key", lambda _: links(docs, prints))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that with the smallest doc_id, null last; of rows with one doc_id the first by
    a hash of the text, then of all columns. Rows that are equal in all columns are one."""
    prints = cut(docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), row_hash(docs).alias("row")))
    return simhash.first_of_classes(docs, prints, "key", lambda _: links(docs, prints))
