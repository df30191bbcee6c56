"""Toxicity by maximum-scoring segments of token log-odds.

Training compares in how many toxic and other texts each token occurs. Log-odds have a Dirichlet prior in proportion
to the token's overall count, and tokens whose log-odds, to either side, stand out by `LEAST_Z` of their standard
deviations score them; every other word costs `DRIFT`. Tokens are words without outer punctuation and their beginnings
of 4 to 6 characters; a word scores as its longest known form.

In a text, one linear scan finds all maximal segments: runs that no extension or cut improves. Under the clean
texts' score distribution a segment of score s in n words is expected K n exp(-lambda s) times by chance
(extreme-value statistics); lambda follows from the clean words' scores, K from how many segments of a high score the
clean training texts have. A text's evidence is log(1 + the sum of -log of the expectation over its segments expected
less than once), and a logistic curve of the evidence, fitted on the training texts, gives the score.

Bounds: labels are learned from at most `TRAIN_ROWS` texts, those with the smallest hash of doc_id; exact copies
count once. All tokens that stand out and occur in `LEAST_TEXTS` texts are kept, so the model's size follows from that
bound.

Defined cases: null and empty texts have no evidence and get the curve's lowest score; null labels and labels
without a text are left out; with no training texts of one kind every score is that kind's smoothed share. Labels
given more than once count once, as toxic if any says so. Repeated rows each give a row; an empty table gives an
empty result. Only doc_id, text and the label are read.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import cut, map_batches, share

TRAIN_ROWS = 20_000
LEAST_Z, LEAST_TEXTS, PRIOR, DRIFT, BY_CHANCE = 3.0, 3, 0.05, 0.25, 200
BEGINNINGS = (6, 5, 4)
#: Words that a task remembers at once, and the longest of them.
CACHE_WORDS, CACHE_LETTERS = 400_000, 64
OUTER = frozenset(string.punctuation)


def tokens(word: str) -> list[str]:
    """The word's forms, longest first; beginnings are marked so that they aren't taken for words."""
    bare = word.strip(string.punctuation)
    return [bare, *(bare[:n] + "*" for n in BEGINNINGS if len(bare) > n)] if bare else []


def training_rows(docs: DataFrame, labels: DataFrame, label: str, in_training: F.Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, label: a row for each of the at most `rows` labelled training doc_ids with the smallest hashes.

    Of the texts that one doc_id has, the first in order counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = known.where(in_training).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def _token_counts(train: DataFrame) -> DataFrame:
    """token, toxic, clean: in how many texts it occurs; an empty token counts the texts, a null one the clean words."""

    def run(batches):
        for batch in batches:
            toxic, clean, words = Counter(), Counter(), 0
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found = (text or "").lower().split()
                own = {""}
                for word in set(found):
                    own.update(tokens(word))
                (toxic if label else clean).update(own)
                words += 0 if label else len(found)
            keys = list(dict.fromkeys([*toxic, *clean]))
            cols = [[*keys, None], [*(toxic.get(k, 0) for k in keys), 0], [*(clean.get(k, 0) for k in keys), words]]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["token", "toxic", "clean"])

    return train.select("text", "label").mapInArrow(run, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Model:
    """scores of the known tokens; rate and level: lambda and K of the extreme-value law; slope and base of the logistic curve."""

    scores: dict[str, float]
    rate: float
    slope: float = 0.0
    base: float = 0.0
    level: float = 0.1

    def word(self, word: str) -> float:
        return next((self.scores[t] for t in tokens(word) if t in self.scores), -DRIFT)


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, (start, end, score), of a sequence that is -drift but at the given places.

    scores: places and scores in order of place. A stack holds disjoint candidates with the running totals
    before and after each, and each one's nearest earlier candidate with a lower total before it. A new one goes back
    over these links and swallows what it improves; where none is lower, all candidates so far are final. So the scan
    is linear in the scores.
    """
    out: list[tuple[int, int, float]] = []
    stack: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, -1
    for place, score in scores:
        total -= drift * (place - last - 1)
        start, before, after = place, total, total + score
        total, last = after, place
        if score <= 0:
            continue
        while True:
            at = len(stack) - 1
            while at >= 0 and stack[at][2] >= before:
                at = stack[at][4]
            if at < 0:
                out += [(s, e, y - x) for s, e, x, y, _ in stack]
                stack.clear()
                break
            if stack[at][3] >= after:
                break
            start, before = stack[at][0], stack[at][2]
            del stack[at:]
        stack.append((start, place + 1, before, after, at))
    return out + [(s, e, y - x) for s, e, x, y, _ in stack]


class Scanner:
    """Segments and evidence of texts.

    A token that scores begins with one of `heads`, the tokens' first four characters, so one look at a word's own
    beginning rules out most words; the others' scores are looked up.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        self.heads = {t[:4] for t in model.scores}
        self.known: dict[str, float] = {}

    def _hits(self, words: list[str]) -> list[tuple[int, float]]:
        heads, known = self.heads, self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        out = []
        # With outer punctuation a word's first four characters aren't its token's.
        for i, w in [(i, w) for i, w in enumerate(words) if (h := w[:4]) in heads or h[0] in OUTER or h[-1] in OUTER]:
            if (score := known.get(w)) is None:
                score = self.model.word(w)
                if len(w) <= CACHE_LETTERS:
                    known[w] = score
            if score != -DRIFT:
                out.append((i, score))
        return out

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and the significant segments in words with their -log expected counts."""
        words = (text or "").lower().split()
        if not (found := segments(self._hits(words))):
            return len(words), []
        level = math.log(self.model.level * len(words))
        return len(words), [(s, e, v) for s, e, x in found if (v := self.model.rate * x - level) > 0]

    def evidence(self, found: list[tuple[int, int, float]]) -> float:
        return math.log1p(sum(v for _, _, v in found))

    def score(self, found: list[tuple[int, int, float]]) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.model.base + self.model.slope * self.evidence(found)))))


def _rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """lambda > 0 with sum(share * exp(lambda * score)) = 1; the mean score is negative."""
    low, high = 0.0, 1.0
    f = lambda x: float((shares * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while f(high) < 0 and high < 1e3:
        high *= 2
    low = high / 1024
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of tokens under the prior, and how many standard deviations they are. A token of all texts has 0."""
    prior = PRIOR * (toxic + clean)
    a, b = toxic + prior, clean + prior
    all_a, all_b = n_toxic * (1 + PRIOR) + PRIOR * n_clean, n_clean * (1 + PRIOR) + PRIOR * n_toxic
    without = lambda part, whole: whole - part + 2 * whole / (all_a + all_b)
    ratio = np.log(a / without(a, all_a)) - np.log(b / without(b, all_b))
    return ratio, ratio / np.sqrt(1 / a + 1 / b)


def fit(train: DataFrame) -> Model:
    """The model of doc_id, text, label rows; train is read twice and bounded."""
    train = cut(train.dropDuplicates(["text", "label"]))
    counts = cut(_token_counts(train))
    sizes = counts.where("token = ''").select("toxic", "clean").first() or (0, 0)
    n_toxic, n_clean = sizes
    if not n_toxic or not n_clean:
        share = (n_toxic + 1) / (n_toxic + n_clean + 2)
        return Model({}, 1.0, 0.0, math.log(share / (1 - share)))
    words = counts.where("token is null").select("clean").first()[0]
    often = counts.where("token <> ''").where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS).toArrow().sort_by("token")
    toxic, clean = (often.column(c).to_numpy().astype(float) for c in ("toxic", "clean"))
    ratio, z = log_odds(toxic, clean, n_toxic, n_clean)
    names = often.column("token").to_pylist()
    keep = np.flatnonzero(np.abs(z) >= LEAST_Z).tolist()
    shares = (clean[keep] + 0.5) / max(words, 1)
    rate = _rate(np.append(ratio[keep], -DRIFT), np.append(shares, max(1 - shares.sum(), 0.5))) if keep else 1.0
    model = Model({names[i]: float(ratio[i]) for i in keep}, rate)
    high = math.log(max(words, 1) / BY_CHANCE) / rate  # BY_CHANCE segments of this score are expected if K is 1
    model.level = (_count_high(train.where("label = 0"), model, high) + 1) / BY_CHANCE
    seen = _evidence(train, model).toArrow()
    model.slope, model.base = _logistic(seen.column("evidence").to_numpy(), seen.column("label").to_numpy())
    return model


def _count_high(texts: DataFrame, model: Model, high: float) -> int:
    """How many segments of the score or more the texts have."""
    shared = share(texts.sparkSession, model)

    def make():
        scanner = Scanner(shared())
        return lambda batch: {"n": [sum(x >= high for _, _, x in segments(scanner._hits((t or "").lower().split()))) for t in batch.column("text").to_pylist()]}

    return map_batches(texts.select("text"), make, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _evidence(train: DataFrame, model: Model) -> DataFrame:
    shared = share(train.sparkSession, model)

    def make():
        scanner = Scanner(shared())
        return lambda batch: {"label": batch.column("label"), "evidence": [scanner.evidence(scanner.segments(t)[1]) for t in batch.column("text").to_pylist()]}

    return map_batches(train.select(F.col("label").cast("int"), "text"), make, "label int, evidence double")


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[float, float]:
    """Slope and base of a ridge-penalized logistic curve, by Newton steps."""
    scale = float(x.max()) or 1.0
    a, w = np.stack([x / scale, np.ones_like(x)], axis=1), np.zeros(2)
    ridge = np.diag([penalty / 100, 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-12)[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, passages for each row of docs; passages: start-end of the significant segments in words, end exclusive, comma-joined."""
    shared = share(docs.sparkSession, model)

    def make():
        scanner = Scanner(shared())

        def one(batch):
            found = [scanner.segments(t)[1] for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "score": list(map(scanner.score, found)), "passages": [",".join(f"{s}-{e}" for s, e, _ in x) for x in found]}

        return one

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, score double, passages string")
