import os
import re
import string
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gridlap.llm import near_copies, oracles, queries, simhash
from gridlap.llm.common import cut, table
from test_near_copies import brute_force

#: The contract's base patterns, with the least length of what counts.
PATTERNS = (
    ("assign", r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]+", 32),
)


def plain_words(text):
    return "".join(" " if c in string.punctuation else c for c in (text or "").lower()).split()


def plain_leaks(texts, items):
    """Ids of the texts in which a stretch of three times the longest item holds 0.8 of an item, of both its question and
    its answer, or all but a twentieth of its question: by five-word shingles, or by words in common runs of three."""
    several = lambda w, n: {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}
    longest = max(len(plain_words(t)) for t in items)

    def measures(item, here):
        at = len(item) - max(5, len(item) // 3) if len(item) >= 10 else 0
        in_runs = {j for i in range(len(item) - 2) if tuple(item[i : i + 3]) in here[1] for j in range(i, i + 3)} if len(item) > 2 else set(range(len(item))) if tuple(item) in here[1] else set()
        for lo, hi in ((0, len(item)), (0, at or len(item)), (at, len(item))):
            fives = several(item[lo:hi], 5)
            yield len(fives & here[0]) / len(fives), sum(lo <= j < hi for j in in_runs) / (hi - lo)

    found, rules = set(), [w for w in map(plain_words, items) if w]
    for i, text in texts.items():
        words = plain_words(text)
        for start in range(0, max(1, len(words)), longest):
            here = [several(words[start : start + 3 * longest], n) for n in (5, 3)]
            for item in rules:
                if not any(tuple(item[j : j + 3]) in here[1] for j in range(0, max(1, len(item) - 2))):
                    continue
                whole, question, answer = measures(item, here)
                if max(whole) >= 0.8 or min(max(question), max(answer)) >= 0.8 or question[1] >= 0.95:
                    found.add(i)
    return found


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(cut(stage(spark, kept[-1], sf_dir)))
        assert kept[-1].columns == docs.columns and kept[-1].count() <= kept[-2].count()
    texts = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in texts[1] for d in good) >= 0.97 * len(good)
    assert set(texts[2]) == set(brute_force(texts[1]).values())
    leaks = plain_leaks(texts[2], [r.text for r in table(spark, sf_dir, "benchmark").collect()])
    assert set(texts[3]) == set(texts[2]) - leaks
    for r in kept[4].collect():
        before, spans = texts[3][r.doc_id], []
        for kind, pattern, least in PATTERNS:
            spans += [m.span() for m in re.finditer(pattern, before) if len(m[2] if kind == "assign" else m[0]) >= least]
        assert all(before[s:e] not in r.text for s, e in spans) and r.n_chars == len(r.text)
        assert (r.text == before) or spans
    coder = Tokenizer.from_file(queries.vocabulary_path())
    out = corpus_pipeline.STAGES[-1][1](spark, kept[4], sf_dir).collect()
    assert len(out) == len(texts[4]) and all(r.ids == coder.encode(texts[4][r.doc_id], add_special_tokens=False).ids for r in out)


ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (1, None, None, None, None), (3, "long text here " * 60_000, "en", "s", 900_000), (3, "Long text here " * 60_000, "en", "t", 900_000)]
NAMES = ("t", "w", "c", "_t", "_keep", "row", "score", "_score", "key", "fp", "id", "whole", "root", "log_words", "upper_share", "cell", "a", "b", "item_id", "n_tokens")


def test_stages_take_odd_empty_and_clashing_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    odd = spark.createDataFrame(ODD, docs.schema)
    more = odd.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])
    for rows in (odd, odd.where("false"), more):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, sf_dir)
            assert out.columns == rows.columns
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count()


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_one_row_of_each_class_at_any_partitioning(spark, parts):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, "zz other words", "a"), (5, "aa first by text", "b"), (5, "aa first by text", "b"), (None, long, "c"), (7, long, "d"), (7, long.upper(), "e"), (8, long, "f"), (None, "only null", "g"), (None, "only null", "h"), (9, None, "i"), (10, "", "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts, "source")
    for module in (near_copies, simhash):
        got = sorted((str(r.doc_id), r.text, r.source) for r in module.deduplicate(docs).collect())
        assert [(d, t) for d, t, _ in got] == [("5", "aa first by text"), ("5", "zz other words"), ("7", got[2][1]), ("9", None), ("None", "only null")]
        assert got == sorted((str(r.doc_id), r.text, r.source) for r in module.deduplicate(docs.repartition(2, "text")).collect())


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Run from another folder, with the package on the driver's path alone."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
spark.range(1).mapInArrow(lambda x: x, "id long").collect()
sys.path.insert(0, {repo!r})
import __spark_entry__
for name in ("op5_decontaminate", "op7_toxicity", "op8_url_filter", "op9_ctw", "pipeline"):
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 10


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_queries_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    found = con.execute(oracles.ORACLES[name])
    names = [d[0] for d in found.description]
    order = [names.index(c) for c in sorted(names)]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*sorted(names)).collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)


def test_entry_registers_all(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
