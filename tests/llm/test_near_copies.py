import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from gridlap.llm import common, near_copies, simhash
from gridlap.llm.common import table


def brute_force(texts):
    """The smallest id of each id's component, over all pairs with a five-word Jaccard similarity of 0.8 or more."""
    sets, posts = {}, defaultdict(list)
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {b" ".join(words[j : j + 5]) for j in range(max(1, len(words) - 4))}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(texts):
        for j, n in Counter(j for s in sets[i] for j in posts[s]).items():
            if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            posts[s].append(i)
    return {i: find(i) for i in texts}


def test_stage_joins_all_pairs_of_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = brute_force({r.doc_id: r.text for r in docs.collect()})
    kept = corpus_pipeline.drop_near_copies(spark, docs, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


@pytest.mark.parametrize("least_hot", [8, 256])
def test_blocks_and_small_cells_give_the_same_classes(spark, monkeypatch, least_hot):
    monkeypatch.setattr(common, "LEAST_HOT", least_hot)  # 8: many cells, texts and groups are hot
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts, hot = {}, " ".join(rng.choice(words) for _ in range(30))
    for i in range(120):
        base = rng.choices(words, k=rng.choice((3, 40, 200))) if i % 4 == 0 else base
        own = list(base)
        for _ in range(rng.choice((0, 1, 2, 5))):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts[i] = " ".join(own) + (" " + hot if i % 3 == 0 else "")
    texts |= {200: None, 201: "", 202: " \n"} | {i: texts[7] for i in range(300, 330)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_force(texts)
    assert len(set(want.values())) < len(texts) - 10
    found = near_copies.connected_components(near_copies.links(docs, near_copies.keyed(docs), cell_rows=4, group_bytes=1000))
    keys = {r.doc_id: r.key for r in docs.select("doc_id", near_copies.text_key().alias("key")).collect()}
    roots = {r.node: r.root for r in found.collect()}
    by_root = defaultdict(list)
    for i, k in keys.items():
        by_root[roots.get(k, k)].append(i)
    assert {i: min(own) for own in by_root.values() for i in own} == want
    assert {r.doc_id: r.component_id for r in near_copies.classes(docs).collect()} == want


def test_a_large_group_moves_its_texts_a_few_times(spark, monkeypatch):
    """Copies of one text with small edits, some that link by a chain only, and a few others that share its cells."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=150)
    texts = {}
    for i in range(300):
        own = list(base)
        for at in rng.sample(range(150), rng.choice((0, 1, 2))):
            own[at] = rng.choice(words)
        texts[i] = " ".join(own)
    chain = list(base)
    for i in range(300, 330):  # each near to the one before only
        chain[(i - 300) * 5] = f"x{i}"
        texts[i] = " ".join(chain)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    moved = []
    real = near_copies._compared
    monkeypatch.setattr(near_copies, "_compared", lambda rows, *task: moved.append(rows.selectExpr("sum(octet_length(text))").first()[0] or 0) or real(rows, *task))
    found = near_copies.connected_components(near_copies.links(docs, near_copies.keyed(docs), group_bytes=8000))
    keys = {r.key: r.doc_id for r in docs.select("doc_id", near_copies.text_key().alias("key")).collect()}
    roots = {r.node: r.root for r in found.collect()}
    want = brute_force(texts)
    by_root = defaultdict(list)
    for k, i in keys.items():
        by_root[roots.get(k, k)].append(i)
    same = {i: min(j for j in own) for own in by_root.values() for i in own}
    assert {i: want[i] for i in same} == {i: min(j for j in same if want[j] == want[i]) for i in same} and len(set(same.values())) == len({want[i] for i in same})
    size = sum(len(texts[i]) for i in same)
    assert size > 20 * 8000 and sum(moved) < 8 * size  # every two of 21 blocks would be 21 times


def plain_bits(hashes):
    """The SimHash of a list of 64-bit hashes, as simhash.fingerprint takes it."""
    return sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("size", [1, 4, 20, 143, 144, 160, 161, 300, 700])
def test_candidates_meet_in_cells_of_simhash_fingerprints(size):
    """Sets at a similarity of 0.8 share a cell; cells are those of the fingerprints' bit counts, and the bound holds."""
    rng = np.random.default_rng(size)
    for _ in range(40):
        more = size // 4
        x = rng.integers(0, 1 << 64, size + more, dtype=np.uint64)
        own = int(rng.integers(0, more + 1))
        a, b = np.unique(x[: size + own]), np.unique(np.concatenate([x[:size], x[size + own :]]))
        assert len(np.intersect1d(near_copies.grid_cells(a), near_copies.grid_cells(b)))
        far = near_copies.whole_print(a) ^ near_copies.whole_print(b)
        assert np.bitwise_count(far.view(np.uint64)).sum() <= near_copies.REACH
    mixed = near_copies._mixed(a + near_copies._ADDED[near_copies.WORDS])
    counts = set()
    for level in {near_copies._level(len(a)), near_copies._level(len(a) * 5 // 4)}:
        for c in range(32):
            if of_class := [h for h, m in zip(a, mixed, strict=True) if int(m) >> (59 - level) == c]:
                counts.add((level, c, int(simhash._unary(np.array([plain_bits(of_class)], dtype=np.uint64))[0])))
    assert len(counts) == len(set(near_copies.grid_cells(a).tolist()))
    for i, added in enumerate(near_copies._ADDED[: near_copies.WORDS]):
        assert int(near_copies.whole_print(a).view(np.uint64)[i]) == plain_bits(near_copies._mixed(a + added))


def test_cells_link_within_the_reach_only():
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 1 << 64, (4, 30), dtype=np.uint64)
    prints[:, 10:20] = prints[:, :10]  # 80 bits of four words: 20 of each
    prints[:, 10:15] ^= np.uint64((1 << 20) - 1)
    prints[:, 15:20] ^= np.uint64((1 << 21) - 1)
    got = near_copies._near_bits(np.arange(30), prints.view(np.int64))
    assert sorted(got) == [(10 + i, i) for i in range(5)]
