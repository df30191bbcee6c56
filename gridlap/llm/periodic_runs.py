"""Periodic runs: the maximal stretches of words that repeat with a period, found by uniting suffixes from long common prefixes to short.

The words of a batch of texts become numbers, those of different texts different ones, so one suffix array serves the
batch and nothing is shared between texts. Kruskal's order follows: neighbours in the suffix array are united by
falling length of their common prefix (LCP). Each class keeps its positions in order, the smaller class goes into the
larger, and two positions that thereby become neighbours at a distance d within the LCP l seed a run of period d from
the first to l words after the second. The first seed of a period and an end is the run's start, as it has the longest
prefix; a distance that is no smallest period can't be seen, since a position in between has a longer prefix and came
before (as long as a run is at least twice its period, and `EXPONENT` is more).

A run is a stretch of words with smallest period q, at least max(`LEAST`, `EXPONENT` * q) long, that no neighbouring
word extends. Collapsing drops the words that a run has after its first q.

A text is worked on by one task, in memory that follows its words; texts of any length are taken whole, and an
n-word text takes O(n log^2 n) steps.

Defined cases: null and empty texts have no words and no runs; text given twice gives its row twice; null doc_ids are
kept; very long and odd words are words like others; an empty table gives an empty result. All columns of the table go
along, whatever their names (as the struct `row`).
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import map_batches, utf8, whole_row

#: A run has at least LEAST words and EXPONENT periods.
LEAST, EXPONENT = 6, 4
#: Texts are worked on together up to so many words; positions of a class lie in buckets of at most BUCKET.
WORDS, BUCKET = 1 << 18, 1024


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the codes and, at each place but the first, the LCP with the suffix before.

    Prefix doubling by sorting, of those suffixes only whose rank is still shared. LCPs are counted in text order: a
    position after one with the same word before it has an LCP of one less, so only the others are compared.
    """
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    first = np.concatenate(([True], rank[order][1:] != rank[order][:-1])) if n else np.zeros(0, bool)
    # a rank is the place of its class in the order
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 1
    shared = np.flatnonzero(~first | np.concatenate((~first[1:], [False]))) if n else np.zeros(0, np.int64)
    while len(shared):
        at = order[shared]
        after = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        by = np.lexsort((after, rank[at]))
        at, after = at[by], after[by]
        order[shared] = at
        was = rank[at]
        new = np.concatenate(([True], (was[1:] != was[:-1]) | (after[1:] != after[:-1])))
        rank[at] = np.maximum.accumulate(np.where(new, shared, 0))
        still = ~new | np.concatenate((~new[1:], [False]))
        shared = shared[still]
        step *= 2
    lcp = np.zeros(n, np.int64)
    if n > 1:
        before = np.full(n, -1, np.int64)
        before[order[1:]] = order[:-1]
        # a suffix can't share more than what is left of the batch; texts end in numbers of their own
        here = np.arange(n)
        known = (here > 0) & (before > 0) & (codes[here - 1] == codes[before - 1])
        length = np.where(before >= 0, _common(codes, here, before, ~known & (before >= 0)), 0)
        lcp_at = np.maximum.accumulate(np.where(known, 0, length + here)) - here
        lcp[1:] = np.where(before >= 0, lcp_at, 0)[order[1:]]
    return order, lcp


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The number of equal codes from a and b on, where wanted: some steps for all at once, then the rest in growing pieces."""
    n, out = len(codes), np.zeros(len(a), np.int64)
    left = np.flatnonzero(wanted)
    for k in range(32):
        left = left[np.maximum(a[left], b[left]) + k < n]
        left = left[codes[a[left] + k] == codes[b[left] + k]]
        out[left] = k + 1
        if not len(left):
            return out
    for i in left.tolist():
        k, piece = 32, 64
        while True:
            x, y = codes[a[i] + k : a[i] + k + piece], codes[b[i] + k : b[i] + k + piece]
            m = min(len(x), len(y))
            odd = np.flatnonzero(x[:m] != y[:m])
            k += int(odd[0]) if len(odd) else m
            if len(odd) or m < piece:
                break
            piece *= 2
        out[i] = k
    return out


class Positions:
    """An ordered set of positions in buckets, for a neighbour search and an insertion of bounded cost."""

    __slots__ = ("buckets", "ends", "size")

    def __init__(self, at: int) -> None:
        self.buckets, self.ends, self.size = [[at]], [at], 1

    def __iter__(self):
        for bucket in self.buckets:
            yield from bucket

    def add(self, at: int) -> tuple[int | None, int | None]:
        """Put a new position in; gives those before and after it."""
        self.size += 1
        i = bisect_left(self.ends, at)
        if i == len(self.ends):
            bucket = self.buckets[-1]
            before, after = bucket[-1], None
            bucket.append(at)
            self.ends[-1] = at
            i -= 1
        else:
            bucket = self.buckets[i]
            k = bisect_left(bucket, at)
            before = bucket[k - 1] if k else self.ends[i - 1] if i else None
            after = bucket[k]
            bucket.insert(k, at)
        if len(bucket) > BUCKET:
            half = len(bucket) // 2
            self.buckets[i : i + 1] = bucket[:half], bucket[half:]
            self.ends[i : i + 1] = bucket[half - 1], bucket[-1]
        return before, after


def runs_of(codes: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """start, length, period of all runs, by start and period."""
    order, lcp = suffixes(codes)
    # a run's first seed has an LCP of its length less its period
    use = np.flatnonzero(lcp >= max(least - max(1, least // exponent), exponent - 1, 1))
    use = use[np.argsort(-lcp[use], kind="stable")]
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}
    found: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    for left, right, length in zip(order[use - 1].tolist(), order[use].tolist(), lcp[use].tolist(), strict=True):
        a, b = root(left), root(right)
        one, other = sets.pop(a, None) or Positions(a), sets.pop(b, None) or Positions(b)
        if one.size < other.size:
            a, b, one, other = b, a, other, one
        parent[b] = a
        sets[a] = one
        within = length // (exponent - 1)
        last, coming = None, iter(other)
        at = next(coming)
        while at is not None:
            then = next(coming, None)
            before, after = one.add(at)
            # neighbours that both come from the smaller class aren't new, nor are those between which one is still to come
            if before is not None and before != last and (d := at - before) <= within and length + d >= least:
                found.setdefault((d, at + length), before)
            if after is not None and (then is None or then > after) and (d := after - at) <= within and length + d >= least:
                found.setdefault((d, after + length), at)
            last, at = at, then
    return sorted((start, end - start, period) for (period, end), start in found.items())


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words as numbers, in which equal words of one text are equal and nothing else is, and where each text begins."""
    codes: list[int] = []
    base, begins = 0, [0]
    for words in texts:
        known: dict[bytes, int] = {}
        codes += [base + known.setdefault(w, len(known)) for w in words]
        base += len(known)
        begins.append(len(codes))
    return np.array(codes, np.int64), np.array(begins, np.int64)


def grouped(texts: list[list[bytes]], most: int = WORDS):
    """The texts in groups of up to `most` words, a longer one alone."""
    group, n = [], 0
    for words in texts:
        if group and n + len(words) > most:
            yield group
            group, n = [], 0
        group.append(words)
        n += len(words)
    if group:
        yield group


def find(texts: list[bytes | None], least: int = LEAST, exponent: int = EXPONENT) -> tuple[list[list[dict]], list[bytes]]:
    """For each text its runs, and its words without the repeats, joined by spaces."""
    runs, kept = [], []
    for group in grouped([(t or b"").split() for t in texts]):
        codes, begins = numbered(group)
        own: list[list[tuple[int, int, int]]] = [[] for _ in group]
        every = runs_of(codes, least, exponent)
        places = np.searchsorted(begins, [r[0] for r in every], "right") - 1 if every else []
        for (start, length, period), i in zip(every, places, strict=True):
            own[i].append((start - int(begins[i]), length, period))
        for words, mine in zip(group, own, strict=True):
            if mine:
                drop = np.zeros(len(words) + 1, np.int64)
                for start, length, period in mine:
                    drop[start + period] += 1
                    drop[start + length] -= 1
                words = [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
            kept.append(b" ".join(words))
    return runs, kept


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """row (all columns of docs), n_words, runs (start, length, period in words, by start and period), collapsed (words without repeats)."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    own = docs.select(whole_row(docs).alias("row"), F.col(text).alias("text"))
    schema = f"row {own.schema['row'].dataType.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def make():
        def one(batch: pa.RecordBatch) -> dict:
            texts = utf8(batch.column(1))
            runs, kept = find(texts, least, exponent)
            return {"row": batch.column(0), "n_words": [len((t or b"").split()) for t in texts], "runs": runs, "collapsed": [k.decode() for k in kept]}

        return one

    return map_batches(own, make, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones that with the smallest start, then period."""
    better = lambda a, b: (b["length"] * a["period"] > a["length"] * b["period"])  # noqa: E731  runs come by start and period
    return F.when(F.size(runs) > 0, F.aggregate(runs, F.element_at(runs, 1), lambda a, b: F.when(better(a, b), b).otherwise(a)))
