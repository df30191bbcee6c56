"""Languages by compression: the text's language is the one whose dictionary makes its zstandard frames smallest.

Each language has a raw-content dictionary, pieces of its training texts, with which every block of a text is compressed
for itself; the sizes of all blocks count. Texts are lower-cased and ASCII characters other than letters become spaces.
Equal sizes go to the language with more training texts, then to the first in order. A text is rejected if the next
language's size is less than `MARGIN` more; the score is 1 / sum of 2^-(size - smallest) over the languages, in bytes.

Bound: a dictionary comes from about `ROWS` texts a language (all, if there are fewer), a share chosen by a hash of the
text, of which the pieces with the smallest hashes fill `DICTIONARY` bytes. Only dictionaries and the languages' counts
come to the driver; of a language only the pieces of its sample meet in one task.

Defined cases: null texts and texts without a letter are `und`, rejected, with score 0; null languages and texts
without a letter teach nothing; without any language every text is `und`; very long texts are compressed whole, block
by block; equal rows get equal results; an empty table gives an empty result. All columns of the table go along,
whatever their names (as the struct `row`).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlap.llm.common import map_batches, share, utf8, whole_row

UNKNOWN = "und"
ROWS, DICTIONARY, PIECE, BLOCK, LEVEL, MARGIN = 2000, 110 * 1024, 400, 4096, 6, 0.02
_PLAIN = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def plain(text: bytes | None) -> bytes:
    """Lower case, ASCII letters and all further characters, words by one space; nothing if there is no letter."""
    if not text:
        return b""
    whole = text.decode()
    return b" ".join(whole.lower().encode().translate(_PLAIN).split()) if _LETTER.search(whole) else b""


@dataclass
class Model:
    """Languages in order of preference, and their dictionaries."""

    dictionaries: dict[str, bytes]

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in self.dictionaries.values():
            own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out


def fit(train: DataFrame, rows: int = ROWS, size: int = DICTIONARY) -> Model:
    """Dictionaries from the columns text and lang."""
    known = train.where("lang is not null and text is not null").select("text", "lang")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return Model({})
    ends = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n) * (1 << 32))))
    chosen = known.where(F.pmod(F.xxhash64("lang", "text"), F.lit(1 << 32)) < ends[F.col("lang")]).select("lang", "text")

    def make():
        def one(batch: pa.RecordBatch) -> dict:
            langs, pieces = [], []
            for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words, held = [], 0
                for word in [*plain(text).split(b" "), None]:
                    if word:
                        words.append(word)
                        held += len(word) + 1
                    if held >= PIECE or word is None and words:
                        langs.append(lang)
                        pieces.append(b" ".join(words).decode())
                        words, held = [], 0
            return {"lang": langs, "piece": pieces}

        return one

    pieces = map_batches(chosen, make, "lang string, piece string").distinct()
    before = F.sum(F.octet_length("piece")).over(Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece").rowsBetween(Window.unboundedPreceding, -1))
    picked = pieces.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < size).groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("piece")), " ").alias("data"))
    found = {r.lang: r.data.encode()[: 2 * size] for r in picked.collect()}
    return Model({lang: found[lang] for lang in sorted(found, key=lambda x: (-counts[x], x))})


def classify(docs: DataFrame, model: Model, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """row (all columns of docs), lang_pred, score, rejected, sizes (bytes by language)."""
    own = docs.select(whole_row(docs).alias("row"), F.col(text).alias("text"))
    schema = f"row {own.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean, sizes map<string, long>"
    given = share(docs.sparkSession, model)

    def make():
        model = given()
        names, compressors = list(model.dictionaries), model.compressors()

        def one(batch: pa.RecordBatch) -> dict:
            out: dict = {"row": batch.column(0), "lang_pred": [], "score": [], "rejected": [], "sizes": []}
            for text in utf8(batch.column(1)):
                data = b" %s " % known if (known := plain(text)) else b""  # as between other words
                sizes = [sum(len(c.compress(data[i : i + BLOCK])) for i in range(0, len(data), BLOCK)) for c in compressors] if data else []
                best = min(sizes, default=0)
                second = sorted(sizes)[1] if len(sizes) > 1 else None
                out["lang_pred"].append(names[sizes.index(best)] if sizes else UNKNOWN)
                out["score"].append(1 / sum(2.0 ** max(-60, best - s) for s in sizes) if sizes else 0.0)
                out["rejected"].append(not sizes or (second is not None and second - best < margin * best))
                out["sizes"].append(list(zip(names, sizes, strict=False)))
            return out

        return one

    return map_batches(own, make, schema)
