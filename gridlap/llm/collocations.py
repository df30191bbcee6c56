"""Collocations: phrases of two to `LONGEST` words that come often, scored against their parts, from Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at `SEPARATORS` and these into words. Prefix polynomials over a block's
bytes give each word's hash, prefix polynomials over those the fingerprint of every n-gram within a piece; numpy makes
both for a whole block at once. The language is part of a fingerprint.

Counting goes by length. A phrase that comes `least` times has parts that do, so n-grams of which a part didn't pass
before aren't counted: what passed is a bit filter of bounded size with two bits a fingerprint, which may let others
through but loses none. The shuffle sums fingerprints that tasks have summed for some millions of n-grams. In the last
pass a block's n-grams that pass are grouped by fingerprint, each with a pointer to its first occurrence; the words
behind every other occurrence are compared with those at the pointer, so fingerprints that collide fall apart, and
only then is the phrase materialised, once a block. Counts are then summed by the phrase itself, along with the pointer
to the first document that has it, so no hash decides about a result.

A phrase's score is floor(2000000 a / (l + r)) for the cut that makes it least, with a, l and r the counts of phrase, left
and right part. A phrase that lies in a longer one with `COVERED` of a hundred of its occurrences is dropped.

Defined cases: null texts are empty, null languages are `und`; texts without words count nothing; a text given twice
counts twice; very long texts are worked on in blocks, cut at separators; a word of any length is a word; a null doc_id
points nowhere; further columns aren't read; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlap.llm.common import arrow_schema, cut, share, utf8

SEPARATORS = ".,;:!?\n\x0b\x0c\r"
LEAST, LONGEST, COVERED, TOP = 30, 4, 80, 2000
#: Bytes of a block when counting and when materialising, n-grams that a task sums before it hands them on, and the filter's bits a fingerprint and at most.
BLOCK, SHOWN, HELD, BITS, MOST_BITS = 1 << 20, 1 << 22, 1 << 22, 16, 1 << 27
#: The polynomials' base, odd so that it has an inverse mod 2^64.
BASE = 0x9E3779B97F4A7C15
_BREAK = 0xFF  # no byte of UTF-8


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of 64 spread over all; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomials:
    """Hashes of ranges of a sequence, from prefix sums of its values times falling powers of the base, mod 2^64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = 1 << n.bit_length()
            steps = lambda b: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64))), dtype=np.uint64)
            self.up, self.down = steps(BASE), steps(pow(BASE, -1, 1 << 64))

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The sum of values[j] * BASE^(end - j) over each range."""
        n = len(values)
        self._grow(n)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.down[:n], out=prefix[1:], dtype=np.uint64)
        return (prefix[ends] - prefix[starts]) * self.up[ends]


class Block:
    """The words of some texts or parts of texts: where they lie, in which piece and part, and their hashes."""

    def __init__(self, parts: list[bytes], langs: np.ndarray, sums: Polynomials) -> None:
        self.data = bytes([_BREAK]).join([*parts, b""])
        data = np.frombuffer(self.data, np.uint8)
        word = (data != 32) & (data != 9) & (data != _BREAK)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.pieces = np.cumsum(data == _BREAK, dtype=np.int64)[self.starts] if len(self.starts) else np.zeros(0, np.int64)
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        self.part = np.searchsorted(begins, self.starts, "right") - 1
        self.langs = langs[self.part]
        self.bytes, self.sums = data, sums
        self.words = mixed(sums.ranges(data.astype(np.uint64), self.starts, self.ends))

    def whole(self, n: int) -> np.ndarray:
        """Where n words lie in one piece."""
        m = len(self.words) - n + 1
        return self.pieces[:m] == self.pieces[n - 1 :] if m > 0 else np.zeros(0, bool)

    def prints(self, n: int) -> np.ndarray:
        """The fingerprints of the n-grams at each word; the last have no n words."""
        at = np.arange(max(0, len(self.words) - n + 1))
        return mixed(self.sums.ranges(self.words, at, at + n) ^ (self.langs[: len(at)] + np.uint64(n)))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words at a and b are equal, byte by byte."""
        size = self.ends - self.starts
        out = size[a] == size[b]
        i = np.flatnonzero(out & (a != b))
        if len(i):
            n = size[a[i]]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            odd = self.bytes[np.repeat(self.starts[a[i]], n) + step] != self.bytes[np.repeat(self.starts[b[i]], n) + step]
            out[i[np.add.reduceat(odd, np.cumsum(n) - n, dtype=np.int64) > 0]] = False
        return out

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join(self.data[self.starts[at + k] : self.ends[at + k]] for k in range(n))

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The n words at each place, joined by spaces."""
        starts, ends = self.starts[at], self.ends[at + n - 1]
        size = ends - starts
        # as it stands in the text, if single spaces part the words
        plain = size == n - 1 + sum((self.ends[at + k] - self.starts[at + k] for k in range(n)), np.zeros(len(at), np.int64))
        for k in range(n - 1):
            plain &= self.bytes[self.ends[at + k]] == 32
        if not plain.all():
            odd = np.flatnonzero(~plain)
            both = pa.concat_arrays([self.phrases(at[plain], n), pa.array([self.phrase(i, n).decode() for i in at[odd].tolist()], pa.string())])
            return both.take(pa.array(np.argsort(np.concatenate((np.flatnonzero(plain), odd)))))
        ends = np.cumsum(size)
        data = self.bytes[np.repeat(starts - ends + size, size) + np.arange(size.sum())]
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(data))

    def ids(self) -> np.ndarray:
        """A number for each word, the same for equal words and for no others; hashes that collide fall apart."""
        _, first, back = np.unique(self.words, return_index=True, return_inverse=True)
        if self.same(np.arange(len(back)), first[back]).all():
            return back
        known: dict[bytes, int] = {}
        return np.array([known.setdefault(self.phrase(i, 1), len(known)) for i in range(len(back))], np.int64)


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[tuple[Block, list, list]]:
    """Blocks of about `size` bytes of (text, lang, doc_id), with each part's doc_id and language."""
    upper = bytes(range(65, 91))
    table = bytes.maketrans(upper + SEPARATORS.encode(), upper.lower() + bytes([_BREAK]) * len(SEPARATORS))
    sums = Polynomials()
    parts, langs, ids, names, held = [], [], [], [], 0

    def made():
        return Block(parts, np.array(langs, np.uint64), sums), ids, names

    for batch in batches:
        for text, lang, doc in zip(utf8(batch.column(0)), utf8(batch.column(1)), batch.column(2), strict=True):
            text, lang = (text or b"").translate(table), b"und" if lang is None else lang
            code, begin = xxhash.xxh3_64_intdigest(lang) & ~0xFFFF, 0
            while begin < len(text):
                end = text.find(_BREAK, begin + size) + 1 or len(text)
                parts.append(text[begin:end])
                langs.append(code)
                ids.append(doc.as_py())
                names.append(lang)
                held += end - begin + 1
                begin = end
                if held >= size:
                    yield made()
                    parts, langs, ids, names, held = [], [], [], [], 0
    if parts:
        yield made()


class Passed:
    """The bit filter of one or more lengths: has() is true of every fingerprint that passed, and of some others."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, prints: np.ndarray) -> np.ndarray:
        out = np.ones(len(prints), bool)
        for p in (prints & self.mask, (prints >> np.uint64(32)) & self.mask):
            out &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0
        return out


def bit_filter(frequent: DataFrame, bits: int = BITS, most: int = MOST_BITS) -> Passed:
    """The filter of the fingerprints (column fp). Its words are made by an aggregate; at most most / 64 of them come to the driver."""
    n = frequent.count()
    size = min(most, max(1 << 10, 1 << max(0, n * bits - 1).bit_length()))
    places = F.explode(F.array(F.expr(f"fp & {size - 1}L"), F.expr(f"shiftrightunsigned(fp, 32) & {size - 1}L")))
    words = frequent.select(places.alias("p")).groupBy(F.expr("shiftright(p, 6)").alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("word")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words["slot"].to_numpy()] = words["word"].to_numpy().view(np.uint64)
    return Passed(out)


def _candidates(block: Block, n: int, passed: dict[int, Passed], prints: dict[int, np.ndarray]) -> np.ndarray:
    """Where n words lie in one piece and the parts of the longest length with a filter below n pass it."""
    ok = block.whole(n)
    m = max((k for k in passed if k < n), default=0)
    if m:
        if m not in prints:
            prints[m] = block.prints(m)
        good = passed[m].has(prints[m])
        for k in range(n - m + 1):
            ok = ok & good[k : k + len(ok)]
    return ok


def _counted(docs: DataFrame, lengths: list[int], passed: dict[int, Passed], least: int, held: int = HELD) -> DataFrame:
    """fp of the n-grams of these lengths with `least` occurrences or more, if their parts pass; written to the shared folder."""
    given = share(docs.sparkSession, passed)
    schema = "fp long, n long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = given()
        kept, n = [], 0

        def summed():
            prints, counts = np.unique(np.concatenate(kept), return_counts=True)
            for i in range(0, len(prints), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(prints[i : i + (1 << 16)].view(np.int64)), pa.array(counts[i : i + (1 << 16)].astype(np.int64))], schema=out)

        for block, _, _ in blocks(batches):
            prints: dict[int, np.ndarray] = {}
            for k in lengths:
                found = block.prints(k)[_candidates(block, k, filters, prints)]
                kept.append(found)
                n += len(found)
            if n >= held:
                yield from summed()
                kept, n = [], 0
        if kept:
            yield from summed()

    return cut(docs.mapInArrow(run, schema).groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("fp"))


def _materialised(docs: DataFrame, longest: int, passed: dict[int, Passed]) -> DataFrame:
    """lang, words, phrase, n, doc_id: n-grams that pass, and the smallest doc_id that has them; words 0 with an empty phrase counts all words."""
    given = share(docs.sparkSession, passed)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"lang string, words int, phrase string, n long, doc_id {kind}"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = given()
        for block, ids, names in blocks(batches, SHOWN):
            own = block.ids()
            firsts = np.searchsorted(block.part, np.arange(len(ids)), "left")
            numbers: dict[bytes, int] = {}
            lang = np.array([numbers.setdefault(x, len(numbers)) for x in names], np.int64)[block.part]
            langs, docs_of = pa.array([x.decode() for x in names]), pa.array(ids, out.field("doc_id").type)
            every = [int(np.count_nonzero(lang == i)) for i in numbers.values()]
            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in numbers]), pa.array([0] * len(numbers), pa.int32()), pa.array([""] * len(numbers)), pa.array(every, pa.int64()), pa.nulls(len(numbers), docs_of.type)], schema=out)
            prints: dict[int, np.ndarray] = {}
            for n in range(1, longest + 1):
                prints[n] = block.prints(n)
                level = filters[min(n, max(filters))]
                at = np.flatnonzero(_candidates(block, n, filters, prints))
                at = at[level.has(prints[n][at])]
                if not len(at):
                    continue
                _, first, back, many = np.unique(prints[n][at], return_index=True, return_inverse=True, return_counts=True)
                pointer = at[first][back]
                equal = lang[at] == lang[pointer]
                for k in range(n):
                    equal &= own[at + k] == own[pointer + k]
                shown = at[first]
                if not equal.all():  # fingerprints that collide: these occurrences by their words
                    many = many - np.bincount(back[~equal], minlength=len(first))
                    apart: dict[tuple[int, bytes], list[int]] = {}
                    for i in at[~equal].tolist():
                        apart.setdefault((int(lang[i]), block.phrase(i, n)), []).append(i)
                    shown = np.concatenate((shown, [x[0] for x in apart.values()]))
                    many = np.concatenate((many, [len(x) for x in apart.values()]))
                part = pa.array(block.part[shown])
                yield pa.RecordBatch.from_arrays([langs.take(part), pa.array(np.full(len(shown), n, np.int32)), block.phrases(shown, n), pa.array(many.astype(np.int64)), docs_of.take(part)], schema=out)

    return docs.mapInArrow(run, schema).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, words, phrase, n, doc_id: every phrase of one to `longest` words that comes `least` times or more in its language, how
    often, and the smallest doc_id where it does; and a row of no words with all words of the language.

    The table is read once for the words, for pairs, for longer phrases and for the texts; between them only filters
    of at most MOST_BITS bits go to the tasks. The result is written to the shared folder.
    """
    if least < 1 or longest < 2:
        raise ValueError("least is 1 or more, longest 2 or more")
    docs = docs.select("text", "lang", "doc_id")
    passed: dict[int, Passed] = {}
    for lengths in [[1], [2], list(range(3, longest + 1))]:
        if lengths:
            passed[lengths[0]] = bit_filter(_counted(docs, lengths, passed, least))
    return cut(_materialised(docs, longest, passed).where((F.col("n") >= least) | (F.col("words") == 0)))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, doc_id: each language's best phrases."""
    found = phrases(docs, least, longest)
    known = found.where("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    own = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), "doc_id")
    part = lambda w, i, k: F.array_join(F.slice(w, i, k), " ")
    split = F.split("phrase", " ")
    cuts = own.withColumn("_w", split).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "words", "a", "doc_id", "k", part(F.col("_w"), 1, F.col("k")).alias("_left"), part(F.col("_w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("_right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    score = F.expr("cast(2000000 as decimal(18, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a", "doc_id").agg(F.min(F.struct("score", "k", "l", "r")).alias("_c"))
    # the greatest count of a longer phrase that a phrase lies in
    inside = own.where("words > 2").withColumn("_w", split).withColumn("_m", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_m") + 1)))
    inside = inside.groupBy("lang", part(F.col("_w"), F.col("_i"), F.col("_m")).alias("phrase")).agg(F.max("a").alias("_longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(f"_longer is null or cast(_longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {int(covered)}")
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", F.col("_c.l").alias("l"), F.col("_c.r").alias("r"), F.col("_c.score").alias("score"), "doc_id").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    every = found.where("words = 0").select("lang", F.col("n"))
    return ranked.join(every, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc_id")
