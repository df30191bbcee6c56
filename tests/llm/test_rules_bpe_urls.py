import random
import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridlap.llm import bpe, quality_rules, url_filter

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n\t", "a b c a b c a b c", "x\nx\n\nx\n y", "É é! #%&", "a\x0bb\x1cc\x85d", "the of and " * 40, "one " * 30000, "a b c d a b c", "|" * 300]


def measured(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    twice = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if twice[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_rule_measures(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "x y")], "doc_id long, text string").selectExpr("*", "1 as n_words", "'k' as kept")
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    for i, text in enumerate(TEXTS):
        r, want = got[i], measured(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(text)[:40]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert None in got and quality_rules.apply_rules(docs.where("false")).count() == 0


def test_rules_drop_junk_and_keep_prose(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = quality_rules.apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(labels, "doc_id").collect()
    assert all(r.kept or r.base_failed for r in got if r.quality == 1)
    assert sum(not r.kept for r in got if r.quality == 0) >= 0.8 * sum(r.quality == 0 for r in got)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoding_equals_the_library(library):
    coder, rng = bpe.Encoder(PATH), random.Random(1)
    pieces = [p.replace("</w>", " ") for p in library.get_vocab()]
    for _ in range(4000):
        text = "".join(rng.choice("abcdeghst'remvl 01!?<|>éß́İΣ한日\n\t\x1c\x85") if rng.random() < 0.6 else rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        text += rng.choice(["", "", "<|endoftext|>", "<|startoftext|>x"])
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == want, repr(text)
        assert coder.vocabulary.decode(want).decode() == library.decode(want, skip_special_tokens=False)


def test_what_tasks_remember_changes_nothing(monkeypatch):
    texts = ["alpha beta gamma delta alpha epsilon " * 3, "zeta eta theta alpha x" + "y" * 80]
    want = [bpe.Encoder(PATH).encode(t) for t in texts]
    for name in ("CACHE_WORDS", "CACHE_LETTERS", "CACHE_PAIRS"):
        monkeypatch.setattr(bpe, name, 1)
    coder = bpe.Encoder(PATH)
    assert [coder.encode(t) for t in texts] == want and len(coder.known) <= 2 and len(coder.vocabulary.together) <= 2


def test_a_piece_is_encoded_once_whatever_words_it_is_in(library, monkeypatch):
    coder, seen = bpe.Encoder(PATH), []
    encode = coder.vocabulary.encode_word
    monkeypatch.setattr(coder.vocabulary, "encode_word", lambda s: seen.append(s) or encode(s))
    text = "éelleç éelleç, (éelleç) éelleç's, éelleç. abc abc, (abc)"
    assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(seen) == len(set(seen))


def test_code_points_are_split_and_lowered_alike(library):
    coder = bpe.Encoder(PATH)
    for c in [*range(0x3000), *range(0x3000, 0x34000, 37), 0x558, 0xA7CB, 0xA7DC, 0x10D50, 0x16EA0, 0x323B0, 0x3D000]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)}"
            assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_every_token_encodes_to_itself():
    v = bpe.Vocabulary(PATH)
    assert all(v.encode_word(s) == [i] for i, s in v.symbols.items())


def test_bpe_digests(spark, library, sf_dir):
    import hashlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (None, "a b"), (-3, "long" * 60000)], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in bpe.digests(docs, PATH).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    short = docs.where("doc_id < 40")
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(short, PATH), PATH).collect()}
    assert all(t == library.decode(library.encode(texts[d], add_special_tokens=False).ids, skip_special_tokens=False) for d, t in back.items())


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/es/deep/", "allow"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com", "block"), ("b.com/", "allow")]
URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x?q#f", "https://a.example.org/es/deep/1", "x://example.org/en/12", "x://notexample.org/es/", "http://com/fr/?", "http://a.b.com", "http://b.com/z", "a://b.com?x=/fr/", "a://org#/", "a://É.org/é", "a://x.example.org/en/2", "a://.org/", "q://a://b.com/"]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = re.match("[^/?#]*", rest)[0] if rest is not None else ""
    path = re.match("[^?#]*", rest[len(host) :])[0] if rest is not None else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(r), len(r.split("/")[0]), r, v) for r, v in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[len(r.split("/")[0]) :])]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


def test_urls_against_every_rule(spark, monkeypatch):
    rng = random.Random(2)
    urls = URLS + ["http://" + ".".join(rng.choice(["a", "b", "example", "org", "com"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "/"]) + "/".join(rng.choice(["es", "en", "fr", "1", "deep", ""]) for _ in range(3)) for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "<html>") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    for at_once in (100, 2):
        monkeypatch.setattr(url_filter, "RULES_AT_ONCE", at_once)
        for r in url_filter.judge(pages, RULES).collect():
            assert (r.host, r.path, r.rule, r.verdict) == judged(urls[r.page_id]), urls[r.page_id]
    assert url_filter.judge(pages.where("false"), RULES).count() == 0 and url_filter.judge(pages, []).where("rule is not null").count() == 0
