"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

A passage's score for an item is the share of the item's own greatest BM25 score that the passage's terms bring. Each item has
a threshold of its own, the least share that any text can have that verification would accept (see least_share), so
retrieval loses nothing. The inverted index holds, for each term, its shares in units of the items' thresholds, in
blocks with their greatest one; a passage asks for all items of which it brings 1 or more, and block-max WAND passes
over items whose bounds can't reach it. What is retrieved is then verified. An item's answer is its last third,
at least five words where it has ten; an item with fewer than ten words is question and answer at once. Two measures
count: the share of five-word shingles that are in the passage, and the share of words that lie in common runs of
`RUN` words or more, which edits of single words leave high. An item is found if by either measure `OVERLAP` of the
whole, or of question and answer each, is there, or if `ALONE` of the question's words are (a leak without its answer).

Passages are windows of a text's words; neighbours overlap by the longest item, so every run of an item's length lies
whole in one of them. Words are compared in lower case without ASCII punctuation.

Counts over the test items are Spark aggregates. The items come to the driver in slices of about `SLICE_BYTES` of
text, each made into an index of its own for a pass over all texts; most test sets are one slice.

Defined cases: null and empty texts and items match nothing; equal items are each found; a text given twice gives
its rows twice; rows with a null item_id or doc_id keep the null. Empty tables give empty results. Only doc_id,
text and item_id are read.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import arrow_schema, cut, share

K1, B, OVERLAP, ALONE, SHINGLE, RUN, BLOCK, COMMON = 1.2, 0.75, 0.8, 0.95, 5, 3, 8, 0.6
#: In units of an item's own threshold, less what sums of floats may lose.
THRESHOLD = 1 - 1e-9
#: Text of a slice: its index takes some fifty times as much memory. Items whose shingles a task keeps at hand.
SLICE_BYTES, LEAST_PASSAGE, KEPT = 1 << 21, 64, 1024
_PLAIN = bytes(32 if chr(b) in string.punctuation else b for b in range(256))

def terms(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_PLAIN).split()


def shingles(words: list[bytes], size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Shingles of the size; fewer words are one shingle."""
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def border(words: list[bytes]) -> int:
    """Where the answer begins; 0 if question and answer are the same."""
    return len(words) - max(SHINGLE, len(words) // 3) if len(words) >= 2 * SHINGLE else 0


class Item:
    """An item's words; its shingles are made when it is looked at."""

    __slots__ = ("border", "threshold", "words")

    def __init__(self, words: list[bytes], threshold: float = 1.0) -> None:
        self.words, self.border, self.threshold = words, border(words), threshold

    def sides(self) -> tuple[list[bytes], list[bytes]]:
        """Question and answer."""
        return (self.words[: self.border], self.words[self.border :]) if self.border else (self.words, self.words)

    def parts(self) -> list[set[tuple[bytes, ...]]]:
        return [shingles(self.words), *map(shingles, self.sides())]

    def overlaps(self, parts: list[set], found: set, runs: set) -> tuple[float, ...]:
        """Of the whole, the question and the answer: the shares of shingles found, and of words in common runs."""
        n, size = len(self.words), min(RUN, len(self.words))
        covered = [False] * n
        for i in range(n - size + 1):
            if tuple(self.words[i : i + size]) in runs:
                covered[i : i + size] = [True] * size
        spans = [covered, covered[: self.border] or covered, covered[self.border :]]
        return (*(len(x & found) / len(x) for x in parts), *(sum(x) / len(x) for x in spans))


def _most_lost(shares: dict[bytes, float], costs: Counter, most: float) -> float:
    """The greatest share that terms can have whose costs sum up to `most` or less, if terms could be split: none can have more."""
    lost = 0.0
    for t, cost in sorted(costs.items(), key=lambda x: (-shares[x[0]] / x[1], x[0])):
        take = min(1.0, most / cost)
        lost += take * shares[t]
        most -= take * cost
        if most <= 0:
            break
    return lost


def least_share(item: Item, shares: dict[bytes, float]) -> float:
    """A lower bound of the share of the item's weight in any passage that `verified` accepts.

    A term that isn't in the passage takes all its places from the covered words, and all shingles with it from the
    found ones, of which each has SHINGLE terms at most. So what can be missing at an overlap of `least` is bounded
    for either measure; of question and answer each loses its own, and beside a question alone all other terms may be missing.
    """

    def lost(words: list[bytes], least: float, shingled: bool = True) -> float:
        # how many may be missing, with room for the rounding of the shares compared
        by_words = _most_lost(shares, Counter(words), (1 - least) * len(words) + 1e-9) if len(words) >= RUN else 0.0
        if not shingled or len(words) < SHINGLE:
            return by_words
        every = shingles(words)
        held = Counter(t for s in every for t in set(s))
        return max(by_words, _most_lost(shares, held, SHINGLE * ((1 - least) * len(every) + 1e-9)))

    question, answer = item.sides()
    beside = sum(x for t, x in shares.items() if t not in set(question))
    losses = [lost(item.words, OVERLAP), lost(question, OVERLAP) + lost(answer, OVERLAP) if item.border else 0.0, beside + lost(question, ALONE, False)]
    return max(0.0, 1 - max(losses))


def verified(whole: float, question: float, answer: float, whole_words: float, question_words: float, answer_words: float) -> bool:
    return max(whole, whole_words) >= OVERLAP or min(max(question, question_words), max(answer, answer_words)) >= OVERLAP or question_words >= ALONE


class Index:
    """Items in blocks of `BLOCK` consecutive numbers. blocks: for each term its blocks with its greatest share in each;
    postings: for each block and term the items in order with their shares, in units of their thresholds.

    The most frequent terms are held apart, as many as together bring no item more than `COMMON` of the threshold:
    no item is reached by these alone, so they need no cursor, only a block's joint bound and a look at an item's shares.
    """

    def __init__(self, rows: list[tuple[bytes, int, float]], items: dict[int, Item], width: int) -> None:
        self.items, self.stride = items, max(LEAST_PASSAGE, width)
        self.parts: dict[int, list[set]] = {}
        self.width = self.stride + width
        block = {item: i // BLOCK for i, item in enumerate(sorted(items))}
        shares: dict[bytes, dict[int, float]] = {}
        for term, item, share in sorted(rows):
            shares.setdefault(term, {})[item] = share
        self.common: dict[int, dict[bytes, float]] = {}
        joint: Counter = Counter()
        for term in sorted(shares, key=lambda t: (-len(shares[t]), t)):
            if max(joint[i] + x for i, x in shares[term].items()) > COMMON * THRESHOLD:
                break
            joint.update(shares[term])
            for i, x in shares.pop(term).items():
                self.common.setdefault(i, {})[term] = x
        self.common_most: dict[int, float] = {b: 0.0 for b in block.values()}
        for i, x in joint.items():
            self.common_most[block[i]] = max(self.common_most[block[i]], x)
        self.postings: dict[int, dict[bytes, tuple[list[int], list[float]]]] = {}
        self.blocks: dict[bytes, list[tuple[int, float]]] = {}
        for term, own in shares.items():
            for i, x in own.items():
                ids, values = self.postings.setdefault(block[i], {}).setdefault(term, ([], []))
                ids.append(i)
                values.append(x)
            self.blocks[term] = [(b, max(self.postings[b][term][1])) for b in sorted({block[i] for i in own})]

    def retrieve(self, query: set[bytes]) -> list[tuple[int, float]]:
        """All items of which the query's terms bring the threshold or more, by block-max WAND."""
        bounds: dict[int, float] = {}
        for term in query:
            for b, most in self.blocks.get(term, ()):
                bounds[b] = bounds.get(b, 0.0) + most
        found = []
        for b, bound in bounds.items():
            if bound + self.common_most[b] >= THRESHOLD:
                found += self._pivots(b, query)
        return sorted(found)

    def _pivots(self, b: int, query: set[bytes]) -> list[tuple[int, float]]:
        """WAND in one block: items are reached in order, and those are passed over that the bounds rule out."""
        lists = [[*self.postings[b][t], most, 0] for t in query for at, most in self.blocks.get(t, ()) if at == b]  # items, shares, bound, place
        here = lambda x: x[0][x[3]]
        found = []
        while lists:
            lists.sort(key=here)
            bound, pivot = self.common_most[b], -1
            for i, x in enumerate(lists):
                bound += x[2]
                if bound >= THRESHOLD:
                    pivot = i
                    break
            if pivot < 0:
                break
            to = item = here(lists[pivot])
            if here(lists[0]) == item:
                score = sum(x[1][x[3]] for x in lists if here(x) == item)
                score += sum(x for t, x in self.common.get(item, {}).items() if t in query)
                if score >= THRESHOLD:
                    found.append((item, score))
                to = item + 1
            for x in lists:
                while x[3] < len(x[0]) and here(x) < to:
                    x[3] += 1
            lists = [x for x in lists if x[3] < len(x[0])]
        return found

    def passages(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        return [(i, s, min(s + self.width, len(words))) for i, s in enumerate(range(0, max(1, len(words) - self.width + self.stride), self.stride))]

    def search(self, text: str | None) -> list[tuple[int, int, float, tuple[float, ...]]]:
        """(item, passage, score, overlaps) of the verified items, with each item's best passage."""
        words, blocks = terms(text), self.blocks
        places = [i for i, w in enumerate(words) if w in blocks]
        best: dict[int, tuple] = {}
        for number, start, end in self.passages(words) if places else ():
            hits = places[bisect_left(places, start) : bisect_left(places, end)]
            bounds: dict[int, float] = {}
            for term in {words[i] for i in hits}:
                for b, most in blocks[term]:
                    bounds[b] = bounds.get(b, 0.0) + most
            if not any([x + self.common_most[b] >= THRESHOLD for b, x in bounds.items()]):
                continue
            found = None
            for item, score in self.retrieve(set(words[start:end])):
                found = found or (shingles(words[start:end]), shingles(words[start:end], RUN))
                own = self.items[item]
                if item not in self.parts:
                    if len(self.parts) >= KEPT:
                        self.parts.clear()
                    self.parts[item] = own.parts()
                overlaps = own.overlaps(self.parts[item], *found)
                if verified(*overlaps) and (item not in best or (overlaps, -number) > (best[item][3], -best[item][1])):
                    best[item] = item, number, score * own.threshold, overlaps
        return list(best.values())


def build(items: list[tuple[int, str]], often: dict[bytes, int] | None = None, count: int = 0, mean: float = 0.0, width: int = 0) -> Index | None:
    """The index of (number, text). often, count, mean and width are of the whole test set: in how many items each term
    is, how many items there are, and their mean and greatest length; without them these items are the whole."""
    held = [(n, w) for n, text in items if (w := terms(text))]
    if not held:
        return None
    if often is None:
        often, count = Counter(t for _, w in held for t in set(w)), len(held)
        mean, width = sum(len(w) for _, w in held) / count, max(len(w) for _, w in held)
    rows, own = [], {}
    for number, words in held:
        brought = {t: math.log(1 + (count - often[t] + 0.5) / (often[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean)) for t, n in Counter(words).items()}
        total = sum(brought.values())
        shares = {t: x / total for t, x in brought.items()}
        item = own[number] = Item(words)
        # every accepted passage has some term of the item, so the least term's share is a bound as well
        item.threshold = max(least_share(item, shares), min(shares.values()))
        rows += [(t, number, x / item.threshold) for t, x in shares.items()]
    return Index(rows, own, width)


def _term_rows(items: DataFrame) -> DataFrame:
    """term, words: a row for each item and term in it, and one with the item's length."""

    def run(batches):
        for batch in batches:
            rows = []
            for words in map(terms, batch.column("text").to_pylist()):
                if words:
                    rows += [(None, len(words)), *((t, None) for t in dict.fromkeys(words))]
            cols = list(zip(*rows, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64())], names=["term", "words"])

    return items.select("text").mapInArrow(run, "term binary, words long")


def indexes(items: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[Index, list]]:
    """An index for each slice of the test set, and the item_id of each of its numbers."""
    items = cut(items.where("text is not null").select("item_id", "text"))
    rows = cut(_term_rows(items))
    count, mean, width = rows.agg(F.count("words"), F.avg("words"), F.max("words")).first()
    if not count:
        return
    often = rows.where("term is not null").groupBy("term").agg(F.count("*").alias("n"))
    slices = max(1, -(-items.agg(F.sum(F.octet_length("text"))).first()[0] // slice_bytes))
    for i in range(slices):
        own = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i)
        here = often if slices == 1 else often.join(_term_rows(own).select("term"), "term", "left_semi")
        table = own.orderBy("item_id", "text").toArrow()
        index = build(list(enumerate(table.column("text").to_pylist())), {bytes(r.term): r.n for r in here.collect()}, count, mean, width)
        if index:
            yield index, table.column("item_id").to_pylist()


_OVERLAPS = ("item_overlap", "question_overlap", "answer_overlap", "item_words", "question_words", "answer_words")


def contaminated(docs: DataFrame, items: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, item_id, passage, score and the overlaps: a row for each text and test item found in it."""
    out = f"doc_id long, item_id {items.schema['item_id'].dataType.simpleString()}, passage int, score double, " + ", ".join(f"{c} double" for c in _OVERLAPS)
    found = None
    for index in indexes(items, slice_bytes):
        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_searcher(share(docs.sparkSession, index), out), out)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], out) if found is None else found


def _searcher(shared, out: str):
    schema = arrow_schema(out)

    def run(batches):
        index, names = shared()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [(doc_id, names[item], number, score, *overlaps) for item, number, score, overlaps in index.search(text)]
            cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def remove_contaminated(docs: DataFrame, items: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """docs without the rows in whose text a test item is found. Rows are judged where they lie: nothing is shuffled."""
    for index, _ in indexes(items, slice_bytes):
        docs = docs.mapInArrow(_sieve(share(docs.sparkSession, index)), docs.schema)
    return docs


def _sieve(shared):
    def run(batches):
        index = shared()
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                yield batch.filter(pa.array([not index.search(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return run
