"""Texts packed for shuffles: zstd with a dictionary trained on a few of them.

The dictionary only makes packed texts smaller; what it was trained on changes no result.
"""

from __future__ import annotations

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts that a dictionary is trained on, and characters of each, at most.
TEXTS, LONGEST = 500, 20_000
DICTIONARY_BYTES = 32_768
LEVEL = 6


class Packing:
    """Packs and unpacks bytes; travels to the tasks as its dictionary."""

    def __init__(self, dictionary: bytes) -> None:
        self.dictionary = dictionary
        self._tools: tuple | None = None

    def __getstate__(self):
        return {"dictionary": self.dictionary, "_tools": None}

    def tools(self) -> tuple:
        if self._tools is None:
            shared = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
            self._tools = (zstandard.ZstdCompressor(level=LEVEL, dict_data=shared),
                           zstandard.ZstdDecompressor(dict_data=shared))
        return self._tools

    def pack(self, data: bytes) -> bytes:
        return self.tools()[0].compress(data)

    def unpack(self, data: bytes) -> bytes:
        return self.tools()[1].decompress(data)


def packing(texts: DataFrame, column: str = "text") -> Packing:
    """A packing for texts like the first ones found of middling length."""
    length = F.char_length(column)
    some = [r[0].encode("utf-8", "surrogatepass") for r in texts.filter(
        length.between(100, LONGEST)).select(column).limit(TEXTS).collect()]
    try:
        return Packing(zstandard.train_dictionary(DICTIONARY_BYTES, some).as_bytes())
    except zstandard.ZstdError:  # too few to learn from
        return Packing(b"")
