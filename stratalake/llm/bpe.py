"""Byte-level BPE encoding and decoding with the tiktoken library and a rank file.

Long texts are cut where the pattern can never join what stands on both sides: before a blank, tab
or line break that follows something else. No alternative of the pattern takes white space after
something else, and none looks back, so the pieces of the parts are the pieces of the text. Merging
never crosses a piece, so the ids are those of the whole text. The library's pattern matcher gives up on
runs of about a million signs of white space, which are never cut: the piece at the begin of a run of ``RUN_CHARS``
is found by the same pattern with the ``regex`` library, which has no such limit, and merged as a single piece. Decoding joins the raw bytes of the
ids; a text is only made of them if they are valid UTF-8.

Null and empty texts have no ids; no ids decode to no bytes. Equal texts get equal ids.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.shared import lean


#: Longer texts are encoded in parts of about so many characters.
PART_CHARS = 1 << 16
#: Columns are worked on in parts of about so many bytes.
PART_BYTES = 1 << 20
#: White space is taken out of a text's parts from so many signs in a row on.
RUN_CHARS = 1 << 14
# fixed values: the signs of white space that the tiktoken library's patterns know as \s
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NEXT_CUT = regex.compile(r"(?<=[^\s\x1c-\x1f])[\t\n\r ]")
_NEXT_RUN = regex.compile(f"[{_WHITE}]{{{RUN_CHARS},}}")


class Ranked(tiktoken.Encoding):
    """The library's encoding by ranks, and its pattern as the ``regex`` library reads it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.matcher = regex.compile("(?V1)" + pattern.replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]"))

    def first_piece(self, text: str, begin: int) -> tuple[int, list[int]]:
        """The end and the ids of the piece that begins there."""
        end = self.matcher.match(text, begin).end()
        return end, self._encode_single_piece(text[begin:end])


def parts_of(batches: Iterator[pa.Array], size: int = PART_BYTES) -> Iterator[pa.Array]:
    """The rows of each batch in as many even parts as it has so many bytes.

    What is made of a part is passed on before the next, so that ids of a whole batch are never held, here or by Spark.
    """
    for batch in batches:
        rows = max(1, size * len(batch) // max(1, batch.nbytes))
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)


_codecs: dict[tuple[int, str], Ranked] = {}


class _Lists:
    """Lists of ids one after another, four bytes for each id."""

    def __init__(self) -> None:
        self.ids, self.ends = array("i"), array("i", [0])

    def add(self, ids: list[int]) -> None:
        self.ids.extend(ids)
        self.ends.append(len(self.ids))

    def array(self) -> pa.ListArray:
        ends, ids = (pa.Array.from_buffers(pa.int32(), len(x), [None, pa.py_buffer(x)]) for x in (self.ends, self.ids))
        return pa.ListArray.from_arrays(ends, ids)


class Codec:
    """Encodes and decodes columns by the ranks in a file.

    ``path`` is read by the driver alone, and its bytes are broadcast: a vocabulary file has a fixed
    size, whatever the input (the limit is ``max_bytes``).
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, max_bytes: int = 1 << 25):
        with open(path, "rb") as file:
            ranks = file.read(max_bytes + 1)
        if len(ranks) > max_bytes:
            raise ValueError(f"{path} is larger than {max_bytes} bytes")
        self._ranks, self._pattern = spark.sparkContext.broadcast(ranks), pattern

    def encode(self, text: Column) -> Column:
        """array<int>: the ids of a text."""
        load = self._loader()

        def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in parts_of(batches):
                codec, made = load(), _Lists()
                for text in texts:
                    made.add(encode_text(codec, text.as_py() or ""))
                yield made.array()

        return F.arrow_udf(lean(ids), "array<int>")(text)

    def encode_checked(self, text: Column) -> Column:
        """A struct of the ids of a text, and whether decoding them gives its bytes back."""
        load = self._loader()

        def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in parts_of(batches):
                codec, made, same = load(), _Lists(), []
                for text in texts:
                    own = text.as_py() or ""
                    ids = encode_text(codec, own)
                    made.add(ids)
                    same.append(codec.decode_bytes(ids) == own.encode())
                yield pa.StructArray.from_arrays([made.array(), pa.array(same, pa.bool_())], ["ids", "round_trip"])

        return F.arrow_udf(lean(checked), "struct<ids: array<int>, round_trip: boolean>")(text)

    def decode(self, ids: Column) -> Column:
        """binary: the bytes of the ids; no ids or null: empty."""
        load = self._loader()

        def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in parts_of(batches):
                codec = load()
                yield pa.array([codec.decode_bytes(x.as_py() or []) for x in column], pa.binary())

        return F.arrow_udf(lean(raw), "binary")(ids)

    def _loader(self) -> Callable[[], Ranked]:
        ranks, pattern = self._ranks, self._pattern

        def load() -> Ranked:
            key = (hash(ranks.value), pattern)
            if key not in _codecs:
                _codecs.clear()
                _codecs[key] = codec_of(ranks.value, pattern)
            return _codecs[key]

        return load


def codec_of(ranks: bytes, pattern: str) -> Ranked:
    """The encoding by lines of a base64 token and its rank."""
    pairs = (line.split() for line in ranks.splitlines() if line.strip())
    return Ranked({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def encode_text(codec: Ranked, text: str, part: int = PART_CHARS) -> list[int]:
    """The ids of a whole text: long runs of white space apart, the rest in parts if it is long."""
    if len(text) <= min(part, RUN_CHARS):
        return codec.encode_ordinary(text)
    ids, begin = [], 0
    for run in _NEXT_RUN.finditer(text):
        ids += _encode_parts(codec, text[begin : run.start()], part)
        begin, own = codec.first_piece(text, run.start())
        ids += own
    return ids + _encode_parts(codec, text[begin:], part)


def _encode_parts(codec: Ranked, text: str, part: int) -> list[int]:
    ids, begin = [], 0
    while begin < len(text):
        cut = _NEXT_CUT.search(text, begin + part)
        end = cut.start() if cut else len(text)
        ids += codec.encode_ordinary(text[begin:end])
        begin = end
    return ids
