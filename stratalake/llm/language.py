"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of a bounded sample of its texts. Texts
are put in lower case first, and all but letters becomes one blank, as digits, signs and capitals say
little about the language. Marks belong to the letters they follow. A text is encoded with every
dictionary, and the language of the smallest encoding is chosen. A margin to the
second one under ``MIN_MARGIN`` of the size is narrow: such a text is marked as rejected, and its
best language is still given. All texts are encoded at one level, whole, in parts of ``PART_BYTES``, else a
long text's own repetitions outweigh the dictionary. Ties go to the language with more training texts, then by name.

Languages are those ``languages`` with the most training texts, ``LANGUAGES`` unless told otherwise, by name
where texts are as many. All others, and a language of that name, are one class, ``other``, with a dictionary of its own from their texts. So a
table with any number of values of ``lang`` costs a bounded broadcast and a bounded number of encodings.

Null texts and those without a letter are ``und`` with score 0. Equal texts get equal results. With
no training text at all, every text is ``und``. Extra columns of the training table are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.shared import lean

#: So many languages have dictionaries of their own; the others are one class.
LANGUAGES = 256
OTHER = "other"
#: The sample of a language: so many texts, so many characters of each, from a place that its hash chooses.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 2048
SALTS = 64
#: Bytes of a dictionary.
DICT_BYTES = 256 << 10
LEVEL = 6
#: Texts are encoded in parts of so many bytes.
PART_BYTES = 4096
#: The part of the smallest size by which the second must be larger.
MIN_MARGIN = 0.01
_NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def sample(docs: DataFrame) -> DataFrame:
    """(lang, part of a text, hash): some texts of each language, chosen by hash.

    First within ``SALTS`` parts of each language, so that no task gets more than a bounded number of
    rows from each other task of a part, whatever a language's share is.
    """
    at = F.xxhash64("doc_id", "text")
    # by the text alone: copies of a text give the same part
    first = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    part = F.substr(F.col("text"), first.cast("int"), F.lit(SAMPLE_CHARS))
    known = docs.where("lang is not null and length(text) > 0").select("lang", part.alias("part"), at.alias("at"))
    salt = F.pmod("at", F.lit(SALTS))
    for keys in ([F.col("lang"), salt], [F.col("lang")]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("at", "part"))
        known = known.withColumn("place", place).where(F.col("place") <= SAMPLE_TEXTS).drop("place")
    return known


class Languages:
    """Dictionaries of languages, broadcast: ``DICT_BYTES`` for each of ``languages`` and one class of the rest."""

    def __init__(self, spark: SparkSession, docs: DataFrame, languages: int = LANGUAGES):
        counts = docs.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang")
        totals = {r["lang"]: r["count"] for r in counts.limit(languages).collect()}
        own = F.broadcast(spark.createDataFrame([(lang, lang) for lang in totals], "lang string, own string"))
        named = F.when(F.col("lang").isNotNull(), F.coalesce("own", F.lit(OTHER)))
        docs = docs.select("doc_id", "text", "lang").join(own, "lang", "left").select("doc_id", "text", named.alias("lang"))
        texts: dict[str, list[str]] = {}
        for row in sample(docs).orderBy("lang", "at", "part").toLocalIterator():
            texts.setdefault(row["lang"], []).append(row["part"])
        # the end of a dictionary is the nearest to the text: copies of a text count once
        dictionaries = {k: "".join(dict.fromkeys(map(letters, v))).encode()[:DICT_BYTES] for k, v in texts.items()}
        self.names = sorted(dictionaries, key=lambda lang: (-totals.get(lang, 0), lang))
        self._shared = spark.sparkContext.broadcast([(lang, dictionaries[lang]) for lang in self.names])

    def predict(self, text: Column) -> Column:
        """A struct of lang, score from 0 to 1, margin in bytes, and whether it is rejected."""
        shared = self._shared

        def of(texts: pa.Array) -> pa.Array:
            coders = _coders(shared.value)
            return pa.array([classify(t.as_py(), coders) for t in texts], pa.struct(_FIELDS))

        return F.arrow_udf(lean(of), "struct<lang: string, score: double, margin: int, rejected: boolean>")(text)


_FIELDS = [("lang", pa.string()), ("score", pa.float64()), ("margin", pa.int32()), ("rejected", pa.bool_())]
Coders = list[tuple[str, zstandard.ZstdCompressor]]
_made: dict[int, Coders] = {}


def _coders(dictionaries: list[tuple[str, bytes]]) -> Coders:
    key = hash(tuple(dictionaries))
    if key not in _made:
        _made.clear()
        _made[key] = [(lang, _coder(data)) for lang, data in dictionaries]
    return _made[key]


def _coder(data: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=False, write_content_size=False)


def letters(text: str) -> str:
    """The words of letters in lower case, a blank around each."""
    words = _NO_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else ""


def classify(text: str | None, coders: Coders) -> dict:
    """The language of one text; ``coders`` are in the order in which ties are broken."""
    data = letters(text or "").encode()
    parts = [data[i : i + PART_BYTES] for i in range(0, len(data), PART_BYTES)]
    if len(data) < 2 or not coders:
        return {"lang": "und", "score": 0.0, "margin": 0, "rejected": True}
    sizes = [sum(len(own.compress(part)) for part in parts) for _, own in coders]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sorted(sizes[:best] + sizes[best + 1 :])
    margin = others[0] - sizes[best] if others else sizes[best]
    score = 1 / (1 + sum(math.exp(-min(s - sizes[best], 700) / 4) for s in others))
    return {"lang": coders[best][0], "score": score, "margin": margin, "rejected": margin < MIN_MARGIN * sizes[best]}
