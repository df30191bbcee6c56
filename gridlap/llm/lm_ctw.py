"""Language-model scores: a word unigram base, and context-tree weighting over binary-decomposed bytes.

Text is read as tokens: its words with A-Z lowered, then one end. For the tree it is the stream of the words' bytes,
each word closed by a space, and a line feed as the end. A byte's context is the `DEPTH` bytes before it, over the
borders of words; before the text there are line feeds. Each byte is eight binary decisions, each with a node in the
contexts of depth 0 to `DEPTH`. A node's estimate is that of Krichevsky and Trofimov from the training counts (one
half where it has seen nothing); its weighted probability is half its own block estimate plus half the product of its
children's, and at the greatest depth its own. A decision's probability mixes the estimates of all depths by the
weights that follow. The code length of a text is what all its bytes take.

All contexts are kept, however rare: what is gathered grows with the corpus. A gram is a context of full depth and the
byte after it; the distinct grams of all texts are one table, dealt out by the three nearest bytes of the context.
Depths 3 to `DEPTH` are weighed inside these groups (at most 2^16 contexts each), depth 2 inside groups of the two
nearest bytes and depth 1 inside groups of the nearest (at most 256 contexts each); the root's 255 nodes are sums that
are weighed on the driver. Mixtures go back down the same way, and each gram gets its log probability.

Grams with at least 1 in 2^23 of all bytes (so at most 2^23 of them, 100 MB) and words with at least 1 in 2^20 of all
tokens (at most 2^20) go to the tasks in broadcasts; a text's other grams and words, counted inside the text, meet
their tables in joins, so neither table has to fit in memory.

Defined cases: a null or empty text has the one token end; a null doc_id counts as an empty text for the fold;
repeated rows are each counted and each scored; a very long text is read in pieces with their contexts. With no
training text at all, N is 0, V is 0 and every byte has probability 1/256. An empty table gives an empty result. Only
doc_id and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import arrow_schema, cut, share, utf8

DEPTH, GRAM_SHARE, WORD_SHARE = 5, 1 << 22, 1 << 20
#: Words, and grams, that a task counts before it hands counts on; bytes, and rows of the tree, that it holds at once.
FLUSH_WORDS, FLUSH_GRAMS, PIECE, ROWS_AT_ONCE = 400_000, 2_000_000, 1 << 21, 400_000
END, BEFORE, GRAM_BITS = b"", b"\n" * DEPTH, 8 * (DEPTH + 1)


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b" \n" if words else b"\n"


def grams(streams: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The grams of the streams in order, in bounded pieces: their numbers; the indices of the streams; where each begins."""
    at = 0
    while at < len(streams):
        parts, own, size = [], [], 0
        while at < len(streams) and size < PIECE:
            if len(streams[at]) > 2 * PIECE:
                if parts:
                    break
                for start in range(0, len(streams[at]), PIECE):
                    body = streams[at][max(0, start - DEPTH) : start + PIECE]
                    yield _grams([body if start else BEFORE + body]), np.array([at]), np.array([0])
            else:
                parts.append(BEFORE + streams[at])
                own.append(at)
                size += len(parts[-1])
            at += 1
        if parts:
            yield _grams(parts), np.array(own), np.cumsum([0, *(len(p) - DEPTH for p in parts[:-1])])


def _grams(parts: list[bytes]) -> np.ndarray:
    """Of each part its bytes from the place DEPTH on, after their contexts: symbol in the lowest byte, then the context, its nearest byte highest."""
    joined = np.frombuffer(b"".join(parts), dtype=np.uint8)
    n = len(joined) - DEPTH
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, 0] = joined[DEPTH:]
    for d in range(DEPTH):
        out[:, d + 1] = joined[d : d + n]
    found = out.view("<i8").ravel()
    if len(parts) > 1:
        inner = np.cumsum([len(p) for p in parts[:-1]])
        mask = np.ones(n, dtype=bool)
        mask[(inner[:, None] - DEPTH + np.arange(DEPTH)).ravel()] = False
        found = found[mask]
    return found


def _merged(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(counts) == 1:
        return counts[0]
    keys = np.concatenate([k for k, _ in counts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(np.concatenate([n for _, n in counts])[order], first)


_COUNTS = "word binary, gram long, train long, rest long"


def corpus_counts(docs: DataFrame) -> DataFrame:
    """word (bytes; empty for the end) or gram, train, rest: how often each occurs in training texts and in the others."""
    schema = arrow_schema(_COUNTS)

    def run(batches):
        words: tuple[Counter, Counter] = Counter(), Counter()
        found: tuple[list, list] = [], []

        def word_rows():
            names = list(dict.fromkeys([*words[0], *words[1]]))
            cols = [pa.array(names, pa.binary()), pa.nulls(len(names), pa.int64()), *(pa.array([c.get(w, 0) for w in names], pa.int64()) for c in words)]
            for c in words:
                c.clear()
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        def gram_rows(held):
            keys, n = _merged(found[held])
            found[held].clear()
            none = np.zeros(len(n), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.binary()), pa.array(keys), *map(pa.array, (none, n) if held else (n, none))], schema=schema)

        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch, streams = whole.slice(start, 1024), ([], [])
                for held, text in zip(batch.column("held_out").to_pylist(), utf8(batch.column("text")), strict=True):
                    own, split = words[held], (text or b"").lower().split()
                    own.update(split)
                    own[END] += 1
                    streams[held].append(stream(split))
                    if len(own) > FLUSH_WORDS:
                        yield word_rows()
                for held in (0, 1):
                    for codes, _, _ in grams(streams[held]):
                        found[held].append(np.unique(codes, return_counts=True))
                    if sum(len(k) for k, _ in found[held]) > FLUSH_GRAMS:
                        found[held][:] = [_merged(found[held])]
                        if len(found[held][0][0]) > FLUSH_GRAMS // 2:
                            yield gram_rows(held)
        yield word_rows()
        for held in (0, 1):
            if found[held]:
                yield gram_rows(held)

    return docs.select("held_out", "text").mapInArrow(run, _COUNTS).groupBy("word", "gram").agg(F.sum("train").alias("train"), F.sum("rest").alias("rest"))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma for x of 0.5 or more, by Stirling's series from x + 8 on."""
    shift = np.log(x)
    for i in range(1, 8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - np.log(np.pi) - _lgamma(zeros + ones + 1.0)


class Level:
    """The nodes of one depth, by key (context and binary node), from rows that each lie under one of them.

    below: the log of each row's weighted probability, if rows are nodes one level down; without it the nodes are leaves.
    """

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> None:
        self.keys, self.row = np.unique(keys, return_inverse=True)
        total = lambda x: np.bincount(self.row, weights=x, minlength=len(self.keys))
        self.zeros, self.ones = total(zeros), total(ones)
        own = block(self.zeros, self.ones)
        self.log = own if below is None else np.logaddexp(own, total(below)) - np.log(2)
        self.weight = np.ones_like(own) if below is None else np.exp(own - np.log(2) - self.log)
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)


def _deep(gram: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, list[Level]]]:
    """For each of a symbol's eight decisions: whether it is a one in each row, and the levels from DEPTH down to 3."""
    symbol, context = gram & 255, gram >> 8
    for k in range(8):
        node, one = 1 << k | symbol >> (8 - k), symbol >> (7 - k) & 1
        levels = [Level(context << 8 | node, n * (1 - one), n * one, None)]
        for _ in range(DEPTH - 3):
            x = levels[-1]
            levels.append(Level(_above(x.keys), x.zeros, x.ones, x.log))
        yield one, levels


def _above(key: np.ndarray) -> np.ndarray:
    """The keys of the nodes one level up, in the context without its furthest byte."""
    return key >> 16 << 8 | key & 255


def _by_groups(df: DataFrame, group: str, order: list[str], work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """work on rows of df in whole groups, some at a time, in order."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS_AT_ONCE:
                table = pa.Table.from_batches(held)
                of = table.column("part").to_numpy()
                last = int(np.searchsorted(of, of[-1]))
                if last:
                    yield work(table.slice(0, last))
                    table = table.slice(last)
                held, size = table.to_batches(), table.num_rows
        if size:
            yield work(pa.Table.from_batches(held))

    return df.withColumn("part", F.expr(group)).repartition("part").sortWithinPartitions("part", *order).mapInArrow(run, schema)


def gram_scores(counts: DataFrame) -> DataFrame:
    """gram, log10_p of each gram in counts (gram, train), by the weighted tree of the training counts."""
    np_of = lambda t, *names: [t.column(c).to_numpy() for c in names]
    nodes, mixed, scored = "key long, zeros double, ones double, log double", "key long, mixed double, remains double", "gram long, log10_p double"
    schemas = {x: arrow_schema(x) for x in (nodes, mixed, scored)}
    batch = lambda x, *cols: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schemas[x], strict=True)], schema=schemas[x])

    def weigh_deep(t):
        found = [levels[-1] for _, levels in _deep(*np_of(t, "gram", "train"))]
        return batch(nodes, *(np.concatenate([getattr(x, c) for x in found]) for c in ("keys", "zeros", "ones", "log")))

    def weigh_up(t):
        key, *sums = np_of(t, "key", "zeros", "ones", "log")
        up = Level(_above(key), *sums)
        return batch(nodes, up.keys, up.zeros, up.ones, up.log)

    above = "shiftright(key, 16)"
    three = cut(_by_groups(counts.select("gram", "train"), "shiftright(gram, 24)", ["gram"], weigh_deep, nodes))
    two = cut(_by_groups(three, above, ["key"], weigh_up, nodes))
    one = _by_groups(two, above, ["key"], weigh_up, nodes)
    tops = one.groupBy(F.col("key").bitwiseAND(255).alias("node")).agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "log"))).toArrow()  # at most 255 rows
    root = Level(*np_of(tops, "node", "zeros", "ones", "log"))
    top_mixed, top_remains = np.zeros(256), np.ones(256)
    top_mixed[root.keys], top_remains[root.keys] = root.weight * root.one, 1 - root.weight

    def mix_one(t):
        key, *sums = np_of(t, "key", "zeros", "ones", "log")
        up = Level(_above(key), *sums)
        p, left = top_mixed[up.keys & 255], top_remains[up.keys & 255]
        return batch(mixed, key, (p + left * up.weight * up.one)[up.row], (left * (1 - up.weight))[up.row])

    def mix_two(t):
        down = t.column("mixed").is_valid().to_numpy()
        at, p_up, left_up = (x[down] for x in np_of(t, "key", "mixed", "remains"))
        key, *sums = (x[~down] for x in np_of(t, "key", "zeros", "ones", "log"))
        up = Level(_above(key), *sums)
        at = np.argsort(at)[np.searchsorted(np.sort(at), up.keys)]
        p, left = p_up[at], left_up[at]
        return batch(mixed, key, (p + left * up.weight * up.one)[up.row], (left * (1 - up.weight))[up.row])

    def mix_deep(t):
        down = t.column("mixed").is_valid().to_numpy()
        key, p_up, left_up = (x[down] for x in np_of(t, "gram", "mixed", "remains"))
        gram, n = (x[~down] for x in np_of(t, "gram", "train"))
        order = np.argsort(key)
        key, p_up, left_up = key[order], p_up[order], left_up[order]
        total = np.zeros(len(gram))
        for one, levels in _deep(gram, n.astype(float)):
            at = np.searchsorted(key, levels[-1].keys)
            p, left = p_up[at], left_up[at]
            for d in range(len(levels) - 1, -1, -1):
                x = levels[d]
                p, left = (p + left * x.weight * x.one)[x.row], (left * (1 - x.weight))[x.row]
            total += np.log10(np.clip(np.where(one == 1, p, 1 - p), 1e-300, 1))
        return batch(scored, gram, total)

    back = _by_groups(two, above, ["key"], mix_one, mixed).select(F.shiftright("key", 8).alias("of"), "key", "mixed", "remains")
    back = three.select(F.shiftright("key", 16).alias("of"), "*").unionByName(back, allowMissingColumns=True)
    back = _by_groups(back, "of", ["key"], mix_two, mixed)
    both = counts.select("gram", "train", F.lit(None).cast("double").alias("mixed"), F.lit(None).cast("double").alias("remains"), (F.shiftright("gram", 24)).alias("of"))
    both = both.unionByName(back.select(F.col("key").alias("gram"), F.lit(0).cast("long").alias("train"), "mixed", "remains", F.shiftright("key", 8).alias("of")))
    return _by_groups(both, "of", ["gram"], mix_deep, scored)


class Lookup:
    """A hash table of gram numbers and their values, for whole arrays at once; at most half full, 16 bytes a slot."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(4, int(2 * len(keys) - 1).bit_length() if len(keys) else 0))
        self.last = (1 << 64 - int(self.shift)) - 1
        self.keys, self.values = np.full(self.last + 1, -1, dtype=np.int64), np.zeros(self.last + 1)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            empty = self.keys[at] < 0
            self.keys[at[empty]] = keys[left[empty]]
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], at[~won] + 1 & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values (0 for keys not held), and the places of keys not held."""
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], 0)
        missing, todo = [np.flatnonzero(held < 0)], np.flatnonzero((held != keys) & (held >= 0))
        at = at[todo]
        while len(todo):
            at = at + 1 & self.last
            held = self.keys[at]
            hit, none = held == keys[todo], held < 0
            out[todo[hit]] = self.values[at[hit]]
            missing.append(todo[none])
            on = ~(hit | none)
            todo, at = todo[on], at[on]
        return out, np.concatenate(missing)


_PARTS = "rid long, doc_id long, held_out boolean, n_tokens long, n_bytes long, n_known long, base double, score double, word binary, gram long, n long"


def _part(docs: DataFrame, words: dict[bytes, float], often: tuple[np.ndarray, np.ndarray], one_less: float) -> DataFrame:
    """For each text what its frequent words and grams give, and a row for each of its other words and grams."""
    shared = share(docs.sparkSession, (words, often))
    schema = arrow_schema(_PARTS)

    def run(batches):
        known, table = shared()
        table = Lookup(*table)
        none = lambda n, i: pa.nulls(n, schema.field(i).type)

        def rare_rows(rid, word, gram, n):
            return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), *(none(len(rid), i) for i in range(1, 8)), none(len(rid), 8) if word is None else pa.array(word, pa.binary()), none(len(rid), 9) if gram is None else pa.array(gram), pa.array(n, pa.int64())], schema=schema)

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                rids, streams, sums, rare = batch.column("rid").to_numpy(), [], [], ([], [], [])
                for rid, text in zip(rids.tolist(), utf8(batch.column("text")), strict=True):
                    words = (text or b"").lower().split()
                    streams.append(stream(words))
                    n_known, base = 0, 0.0
                    words.append(END)
                    for word, n in Counter(words).items():
                        if (log := known.get(word)) is not None:
                            if log:
                                n_known += n
                                base += n * log
                        else:
                            rare[0].append(rid)
                            rare[1].append(word)
                            rare[2].append(n)
                    sums.append((len(words), len(streams[-1]), n_known, base - len(words) * one_less))
                score = np.zeros(len(streams))
                for codes, own, first in grams(streams):
                    logs, missing = table.find(codes)
                    score[own] += np.add.reduceat(logs, first, dtype=float)
                    if len(missing):
                        of = own[np.searchsorted(first, missing, side="right") - 1]
                        pair, n = np.unique(of << GRAM_BITS | codes[missing], return_counts=True)
                        yield rare_rows(rids[pair >> GRAM_BITS], None, pair & (1 << GRAM_BITS) - 1, n)
                cols = [*zip(*sums, strict=True), score]
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), batch.column("held_out"), *(pa.array(c, schema.field(i).type) for i, c in enumerate(cols, 3)), *(none(len(sums), i) for i in (8, 9, 10))], schema=schema)
                yield rare_rows(rare[0], rare[1], None, rare[2])

    return docs.select("rid", "doc_id", "held_out", "text").mapInArrow(run, _PARTS)


def score(docs: DataFrame, folds: int = 7, held: int = 2, gram_share: int = GRAM_SHARE, word_share: int = WORD_SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for each row of docs."""
    docs = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), (fold() % folds == held).alias("held_out"), "text")
    counts = cut(corpus_counts(docs))
    words, every = counts.where("word is not null").select("word", "train", "rest"), counts.where("gram is not null").select("gram", "train", "rest")
    sizes = lambda df: df.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count_if(F.col("train") > 0), F.coalesce(F.sum(F.col("train") + F.col("rest")), F.lit(0))).first()
    (n_train, distinct, n_tokens), (_, _, n_bytes) = sizes(words), sizes(every)
    values = cut(gram_scores(every))
    top = words.where((F.col("train") + F.col("rest")) * word_share >= n_tokens).select("word", "train").toArrow()  # at most word_share rows
    known = dict(zip(top.column("word").to_pylist(), np.log10(top.column("train").to_numpy() + 1.0).tolist(), strict=True))
    often = every.where((F.col("train") + F.col("rest")) * gram_share >= n_bytes).select("gram").join(values, "gram").toArrow()  # at most gram_share rows
    parts = cut(_part(docs, known, tuple(often.column(c).to_numpy() for c in ("gram", "log10_p")), float(np.log10(n_train + distinct + 1))))
    rare_words = parts.where("word is not null").select("rid", "word", "n").join(words.select("word", "train"), "word")
    rare_words = rare_words.select("rid", F.when(F.col("train") > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * F.log10(F.col("train") + 1.0)).alias("base"), F.lit(0.0).alias("score"))
    rare_grams = parts.where("gram is not null").select("rid", "gram", "n").join(values, "gram")
    rare_grams = rare_grams.select("rid", F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"), (F.col("n") * F.col("log10_p")).alias("score"))
    texts = parts.where("word is null and gram is null").select("rid", "doc_id", "held_out", "n_tokens", "n_bytes", "n_known", "base", "score")
    rare = [r.select("rid", *(F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_bytes")), "n_known", "base", "score") for r in (rare_words, rare_grams)]
    whole = texts.unionByName(rare[0]).unionByName(rare[1]).groupBy("rid").agg(*(F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_bytes")), *(F.sum(c).alias(c) for c in ("n_known", "base", "score")))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score", (-F.col("score") / F.col("n_bytes") * F.log2(F.lit(10.0))).alias("bits_per_byte"))
