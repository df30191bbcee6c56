"""Periodic runs, collocations and language ID against plain versions and held-out labels."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlap.llm import collocations, language_id, periodic_runs, queries

ODD = [(-1, None), (-2, ""), (-3, " \n "), (None, "a b"), (-4, "x" * 100_000), (-5, "ab " * 40_000), (-4, "x" * 100_000), (-6, "\x00 中文 é\tÉ"), (-7, "12 + 3")]


def plain_runs(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if (size := j - i + q) >= max(least, exponent * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def periodic(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 2)):
        if n:
            a, p = rng.randrange(n), rng.randint(1, 7)
            end = rng.randint(a, n)
            w = [w[a + (i - a) % p] if a <= i < end and a + (i - a) % p < n else x for i, x in enumerate(w)]
    return w


def test_runs_equal_their_definition():
    rng = random.Random(1)
    found = 0
    for _ in range(3000):
        w = periodic(rng, rng.randint(0, 70), rng.choice((1, 2, 3, 6)))
        exponent, least = rng.choice((4, 4, 3, 2)), rng.choice((6, 2, 9))
        got = periodic_runs.runs_of(np.array(w, np.int64), least, exponent)
        assert got == plain_runs(w, least, exponent)
        found += len(got)
    assert found > 3000


def test_suffixes_equal_a_sort():
    rng = random.Random(2)
    for _ in range(300):
        w = periodic(rng, rng.randint(0, 150), rng.choice((1, 2, 9)))
        order, lcp = periodic_runs.suffixes(np.array(w, np.int64))
        assert order.tolist() == sorted(range(len(w)), key=lambda i: w[i:])
        for a, b, n in zip(order, order[1:], lcp[1:], strict=False):
            assert w[a : a + n] == w[b : b + n] and (max(a, b) + n == len(w) or w[a + n] != w[b + n])


def test_long_periodic_texts_take_near_linear_time():
    rng = random.Random(3)
    for text in (b"a " * 200_000, b" ".join(b"%d" % (i % 1000) for i in range(200_000)), b" ".join(b"%d" % rng.randrange(3) for _ in range(200_000))):
        began = time.process_time()
        runs, kept = periodic_runs.find([text])
        assert runs[0] and len(kept[0]) <= len(text) and time.process_time() - began < 20


def test_positions_stay_in_order():
    rng = random.Random(4)
    at = rng.sample(range(100_000), 5000)
    held = periodic_runs.Positions(at[0])
    for i, x in enumerate(at[1:], 1):
        if i % 500 == 0:
            known = sorted(at[:i])
            k = np.searchsorted(known, x)
            assert held.add(x) == (known[k - 1] if k else None, known[k] if k < len(known) else None)
        else:
            held.add(x)
    assert list(held) == sorted(at) and held.size == len(at)


def plain_op11(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    runs = plain_runs(w)
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else None
    gone = {k for s, size, p in runs for k in range(s + p, s + size)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_op11_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op11_periodic_runs(spark, sf_dir).collect()
    assert len(got) == len(texts)
    looked = 0
    for r in got:
        if len(texts[r.doc_id]) < 5000:
            assert tuple(r)[1:] == plain_op11(r.doc_id, texts[r.doc_id])
            looked += 1
    assert looked > 100


def test_runs_of_odd_rows_and_columns(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"runs": F.lit(1), "collapsed": F.lit("x")})
    got = periodic_runs.find_runs(docs).collect()
    assert len(got) == len(ODD)
    found = {r.row.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got}
    assert found[-5] == (40_000, [(0, 40_000, 1)], "ab") and found[-1] == (0, [], "") and found[None] == (2, [], "a b")
    assert {r.row.runs for r in got} == {1}
    assert periodic_runs.find_runs(docs.where("false")).count() == 0
    planted = queries.planted_repeats(docs).collect()
    assert len(planted) == len(ODD) and next(r.text for r in planted if r.doc_id is None) == "a b"


def plain_counts(rows):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    return counts, n


def plain_collocations(rows, least=30, top=2000):
    counts, n = plain_counts(rows)
    phrases = {k: v for k, v in counts.items() if v >= least and len(k[1]) > 1}
    drop = {(lang, w[i : i + m]) for (lang, w), v in phrases.items() for m in range(2, len(w)) for i in range(len(w) - m + 1) if 100 * v >= 80 * counts[lang, w[i : i + m]]}
    out = []
    for (lang, w), a in phrases.items():
        if (lang, w) not in drop:
            score, k = min((2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    out.sort()
    ranks = Counter()
    want = []
    for lang, score, a, phrase, left, right in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            want.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return want


def made_up(rng, n):
    words = ["an", "of", "the", "big", "red", "Fox", "ÉTÉ", "x\x0by", "\x00", "中"]
    seps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "!"]
    return [("".join(rng.choice(words[: rng.choice((4, 10))]) + rng.choice(seps) for _ in range(rng.randint(0, 60))), rng.choice(("en", "fr", None, "und"))) for _ in range(n)]


@pytest.mark.parametrize("weak", [False, True])
def test_collocations_equal_plain_counts(spark, monkeypatch, weak):
    """weak: few different hashes, so that words and phrases collide and only their texts tell them apart."""
    if weak:
        monkeypatch.setattr(collocations, "mixed", lambda x: (x ^ (x >> np.uint64(7))) & np.uint64(31))
    rng = random.Random(5)
    rows = made_up(rng, 400) + [(None, "en"), ("", None), ("the of " * 3000, "en"), ("a.b", "xx")]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)
    got = [tuple(r)[:8] for r in collocations.collocations(docs, top=25).collect()]
    want = plain_collocations(rows, top=25)
    assert sorted(got) == sorted(want) and len(want) > 40
    known = {(r.lang, r.phrase): r.n for r in collocations.phrases(docs).collect()}
    counts, n = plain_counts(rows)
    assert known == {(lang, " ".join(w)): v for (lang, w), v in counts.items() if v >= 30} | {(lang, ""): v for lang, v in n.items() if v}


def test_op12_against_plain_counts(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op12_collocations(spark, sf)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_collocations(rows))


def test_collocations_count_past_64_bits(spark):
    """Counts whose product with 2,000,000 needs more than 64 bits."""
    big = 1 << 50
    df = spark.createDataFrame([(big, 2 * big + 1, 3 * big)], "a long, l long, r long")
    made = df.select(F.expr("cast(2000000 as decimal(18, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))").alias("s")).first().s
    assert made == 2_000_000 * big // (5 * big + 1)


def test_blocks_give_every_word_whatever_their_size():
    import pyarrow as pa

    rng = random.Random(6)
    texts = ["".join(rng.choice("ab ,\n\t") for _ in range(rng.choice((0, 5, 300)))) for _ in range(40)] + [None, "word" * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts)), pa.array(range(len(texts)))], names=["text", "lang", "doc_id"])
    want = Counter(w for t in texts for w in re.findall(r"[^\x20\x09-\x0D,]+", t or ""))
    for size in (1, 64, 1 << 20):
        got = Counter()
        for block, ids, _ in collocations.blocks(iter([batch]), size):
            got.update(block.phrases(np.flatnonzero(block.whole(1)), 1).to_pylist())
            assert all(texts[ids[p]] for p in block.part)
        assert got == want


def test_collocations_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, "en")], docs.schema)).count() == 0


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op13_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    sure = [r for r in held if not r.rejected]
    assert len(sure) >= 0.95 * len(held) and sum(r.lang_pred == r.lang for r in sure) >= 0.98 * len(sure)


def test_languages_of_odd_rows_and_few_examples(spark):
    train = spark.createDataFrame([("the cat and the dog and the bird", "en"), ("le chat et le chien et le loup", "fr"), (None, "en"), ("xyz", None), ("42 !", "de")], "text string, lang string")
    model = language_id.fit(train)
    assert set(model.dictionaries) == {"en", "fr"}
    docs = spark.createDataFrame(ODD + [(1, "The CAT, and the dog!"), (2, "et le chien et le chat")], "doc_id long, text string").withColumns({"score": F.lit(2), "lang_pred": F.lit("z")})
    got = {r.row.doc_id: r for r in language_id.classify(docs, model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred) == ("en", "fr") and not got[1].rejected
    assert {got[d].lang_pred for d in (-1, -2, -3, -7)} == {"und"} and got[-6].lang_pred in ("en", "fr") and got[-1].score == 0
    none = language_id.fit(train.where("false"))
    assert {r.lang_pred for r in language_id.classify(docs, none).collect()} == {"und"}
    assert language_id.classify(docs.where("false"), model).count() == 0


def test_dictionaries_do_not_depend_on_the_layout(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    models = [language_id.fit(docs.repartition(n), size=4000) for n in (1, 6)]
    assert models[0] == models[1] and all(len(d) <= 8000 for d in models[0].dictionaries.values())


def test_whole_texts_are_compressed(spark):
    rng = random.Random(7)
    model = language_id.Model({"a": " ".join(f"alfa{i}" for i in range(300)).replace("1", "x").encode(), "b": b"nothing of the kind"})
    words = list(model.dictionaries["a"].split())
    noise = " ".join("".join(rng.choices("qwrtz", k=9)) for _ in range(800))
    docs = spark.createDataFrame([(1, noise + " " + b" ".join(rng.choices(words, k=4000)).decode())], "doc_id long, text string")
    assert language_id.classify(docs, model).first().lang_pred == "a"
