"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

An Aho-Corasick automaton gives the longest token at each position of a word. The encoder takes it if the token
may follow its predecessor: a pair may stand together if plain BPE, run on the two tokens' joined text, would
give back just these two. If not, it tries the token's next shorter prefix, and where none is left it goes a token
back and marks the position as a dead end, so a position is left at most once: the result equals that of the
merges, in linear time.

The vocabulary file is that of the `tokenizers` library: byte-level symbols, a mark at a word's end, merges in
order of rank. Its path is a parameter.

Defined cases: a null text counts as empty and has no tokens; special tokens' strings in a text become their ids,
as the library has it. A text that isn't split at white space alone is treated whole. Words, and
the pieces they are made of, are cached up to a fixed number in each task. Empty tables give empty results; only doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from itertools import accumulate

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from gridlap.llm.common import map_batches

#: Words, and pieces of words, whose tokens a task remembers at once.
CACHE_WORDS = 400_000
#: Longer words aren't remembered.
CACHE_LETTERS = 64
#: Pairs of tokens that a task remembers at once.
CACHE_PAIRS = 1_000_000
#: A final symbol is held as the symbol this much further on.
FINAL = 0x1000


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes are counted up from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Vocabulary:
    """A word vocabulary: the automaton, the pair table's parts, and the offset table for decoding."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids, self.end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        #: The rule that splits words into pieces.
        self.pieces = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.base = len(ids) - len(pairs)
        self.symbols: dict[int, str] = {}
        for i in range(self.base):
            name = names[i]
            self.symbols[i] = chr(ord(name[0]) + FINAL) if name != self.end and name.endswith(self.end) else name
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for a, b in pairs:
            whole = ids[a + b]
            self.merged[ids[a], ids[b]] = whole
            self.parts[whole] = ids[a], ids[b]
            self.symbols[whole] = self.symbols[ids[a]] + self.symbols[ids[b]]
        self.matcher = ahocorasick.Automaton()
        known = {s: i for i, s in self.symbols.items()}
        for s, i in known.items():
            self.matcher.add_word(s, (len(s), i))
        self.matcher.make_automaton()
        self.sizes = {i: len(s) for s, i in known.items()}
        #: For each token its longest proper prefix that is a token, or -1.
        self.shorter = {i: next((known[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in known), -1) for s, i in known.items()}
        self.together: dict[tuple[int, int], bool] = {}
        self.alphabet = byte_symbols()
        count = max(names) + 1
        pieces = [names.get(i, "").encode() for i in range(count)]
        self.offsets = [0, *accumulate(len(p) for p in pieces)]
        self.bytes = b"".join(pieces)

    def compatible(self, left: int, right: int) -> bool:
        """Whether plain BPE leaves the two tokens' joined text as these two.

        The last merges on either side of the border are undone in order of rank, latest first. The pair fails if the
        tokens that then touch the border could have merged across it before the merge last undone.
        """
        key = left, right
        if (found := self.together.get(key)) is None:
            if len(self.together) > CACHE_PAIRS:
                self.together.clear()
            found = self.together[key] = self._compatible(left, right)
        return found

    def _compatible(self, left: int, right: int) -> bool:
        undone = 1 << 62
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < undone:
                return False
            # On equal rank the left merge comes first, so the right one is undone first.
            if left > right and left in self.parts:
                undone, left = left, self.parts[left][1]
            elif right in self.parts:
                undone, right = right + 1, self.parts[right][0]
            elif left in self.parts:
                undone, left = left, self.parts[left][1]
            else:
                return True

    def encode_word(self, symbols: str) -> list[int]:
        """The tokens of one word, given as symbols with the final one marked."""
        # Mostly the longest tokens, one after the other, already go together; any tokens that do so are the result.
        found, at, before, together = [], 0, -1, self.together
        for last, (size, token) in self.matcher.iter_long(symbols):
            if last + 1 - size != at:
                break
            if before >= 0:
                fits = together.get((before, token))
                if not (self.compatible(before, token) if fits is None else fits):
                    break
            found.append(token)
            before = token
            at += size
        return found if at == len(symbols) else self._backtrack(symbols, found, at)

    def _longest(self, symbols: str, at: int) -> int:
        """The longest token that begins at a position, or -1."""
        last, (size, token) = next(self.matcher.iter_long(symbols, at), (-1, (0, -1)))
        return token if last + 1 - size == at else -1

    def _backtrack(self, symbols: str, found: list[int], at: int) -> list[int]:
        n, sizes, shorter, together = len(symbols), self.sizes, self.shorter, self.together
        dead = bytearray(n + 1)
        token = self._longest(symbols, at)
        while at < n:
            before = found[-1] if found else -1
            while token >= 0:
                end = at + sizes[token]
                if not dead[end]:
                    if before < 0:
                        break
                    fits = together.get((before, token))
                    if self.compatible(before, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                at = end
                if at < n:
                    token = self._longest(symbols, at)
            elif found:
                dead[at] = 1
                token = found.pop()
                at -= sizes[token]
                token = shorter[token]
            else:
                raise ValueError("the vocabulary has no token for a symbol")
        return found

    def decode(self, ids: list[int]) -> bytes:
        """The library's decode without a decoder: the tokens' strings, joined by spaces."""
        table, at = self.bytes, self.offsets
        return b" ".join([table[at[i] : at[i + 1]] for i in ids])


WHITE = regex.compile(r"\s+")
#: Code points that are letters or numbers in newer Unicode tables than the library's (16.0), in hexadecimal.
NEWER_LETTERS = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda "
    "18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
#: Whether a run is letters of Latin-1 and its extensions only, which the library's tables have as letters too.
LATIN = re.compile("[a-zß-öø-ÿĀ-ƿǄ-ʯ]+").fullmatch
NEWER = regex.compile("[" + "".join("-".join(chr(int(x, 16)) for x in part.split("-")) for part in NEWER_LETTERS.split()) + "]")
#: Lower-case forms that the library has and Python's older tables lack.
LOWER_NEWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
#: The characters of LOWER_NEWER.
TO_LOWER = re.compile("[" + "".join(map(chr, sorted(LOWER_NEWER))) + "]")
#: White space for str.split, but not for the split rule.
ODD = regex.compile("[\x1c-\x1f]")


class Known(dict):
    """Words, or pieces, as ready text, made where they are missing; at most CACHE_WORDS, none of more than CACHE_LETTERS."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> tuple[bytes, int, bytes]:
        ready = self.make(word)
        if len(word) <= CACHE_LETTERS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ready
        return ready


class Encoder:
    """Texts to tokens, with words and their pieces remembered as ready text."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.known = Known(self._word)
        self.pieces = Known(self._piece)
        #: For each byte's code point its symbol, as str.translate takes it.
        self.shown = "".join(self.vocabulary.alphabet)
        marks = sorted(self.vocabulary.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def _word(self, word: str) -> tuple[bytes, int, bytes]:
        if LATIN(word):  # one piece
            return self.pieces[word]
        shape = word if word.isascii() else NEWER.sub("\uffff", word)
        found = [self.pieces[word[p.start() : p.end()]] for p in self.vocabulary.pieces.finditer(shape)]
        if len(found) == 1:
            return found[0]
        ids, sizes, said = zip(*found, strict=True) if found else ((), (), ())
        return b" ".join(ids), sum(sizes), b" ".join(said)

    def _piece(self, piece: str) -> tuple[bytes, int, bytes]:
        # an ASCII letter's byte is its own symbol
        s = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.shown)
        return self._ready(self.vocabulary.encode_word(s[:-1] + chr(ord(s[-1]) + FINAL)))

    def _ready(self, ids: list[int]) -> tuple[bytes, int, bytes]:
        return " ".join(map(str, ids)).encode(), len(ids), self.vocabulary.decode(ids)

    def parts(self, text: str) -> list[tuple[bytes, int, bytes]]:
        """For each run of the text that has tokens: its ids as text, their number, and what they decode to."""
        out: list[tuple[bytes, int, bytes]] = []
        runs = self.marks.split(text) if self.marks and "<|" in text else [text]
        for run in runs:
            if (mark := self.vocabulary.special.get(run)) is not None:
                out.append(self._ready([mark]))
                continue
            run = normalized(run)
            words = list(filter(None, WHITE.split(run))) if ODD.search(run) else run.split()
            out += map(self.known.__getitem__, words)
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for ids, _, _ in self.parts(text or "") for i in ids.split()]


def normalized(run: str) -> str:
    """Composed and in lower case, a character at a time: a final sigma isn't told apart."""
    if not run.isascii():
        run = unicodedata.normalize("NFC", run).replace("Σ", "σ").lower()
        return run.translate(LOWER_NEWER) if TO_LOWER.search(run) else run
    return run.lower()


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _digested(docs: DataFrame, path: str, with_ids: bool) -> DataFrame:
    def make():
        coder = Encoder(path)

        def one(batch):
            out = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for text in batch.column("text").to_pylist():
                found = coder.parts(text or "")
                ids, sizes, said = zip(*found, strict=True) if found else ((), (), ())
                ids = b" ".join(ids)
                out["n_tokens"].append(sum(sizes))
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(b" ".join(said)).hexdigest())
                if with_ids:
                    out["ids"].append(np.array(ids.split(), dtype=np.int32))
            return out

        return one

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), make, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text, encoded and decoded with the vocabulary at path."""
    return _digested(docs, path, False)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """The digests and the token ids themselves."""
    return _digested(docs, path, True)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: each text's token ids."""

    def make():
        coder = Encoder(path)
        return lambda batch: {"doc_id": batch.column("doc_id"), "ids": [coder.encode(t) for t in batch.column("text").to_pylist()]}

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: what each list of ids decodes to; null ids give an empty text."""

    def make():
        v = Vocabulary(path)
        return lambda batch: {"doc_id": batch.column("doc_id"), "text": [v.decode(x or []).decode() for x in batch.column("ids").to_pylist()]}

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id long, text string")
