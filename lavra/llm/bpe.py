"""Byte-pair encoding by prefix dynamic programming, and the corpus encoder built on it.

For every prefix of a byte string exactly one token can be the last one of its encoding. A token ``t`` that
ends at ``i`` is that token exactly if it may follow the last token of the prefix it leaves over. The table of
last tokens therefore is the whole state: appending bytes only adds entries, and an edit changes entries only until
the table meets its old values again over the length of the longest token.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pre-tokenisation pattern of the public byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries a worker remembers (units of text and byte pieces); a full memory is emptied, which costs time, never results.
MEMORY = 400_000


def default_vocabulary() -> str:
    """Path of ``byte_bpe_50k`` as the installed package of public vocabularies gives it."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PrefixCoder:
    """Encoding of byte strings for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        size = max(ranks.values()) + 1
        self._bytes: list[bytes] = [b""] * size
        for b, t in ranks.items():
            self._bytes[t] = b
        # every end of a token, with the token's id where the end is a whole token
        self.ends: dict[bytes, int] = {b[at:]: -1 for b in ranks for at in range(1, len(b))} | ranks
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        for t, b in enumerate(self._bytes):
            for cut in range(1, len(b)):
                x, y = ranks.get(b[:cut]), ranks.get(b[cut:])
                if x is not None and y is not None and x < t and y < t and self._adjacent(x, y):
                    self.left[t], self.right[t] = x, y
                    self.merged[x, y] = t
                    break

    def _adjacent(self, x: int, y: int) -> bool:
        """Whether encoding the bytes of ``x`` and ``y`` as one string leaves a border between them.

        The merges of both sides are undone from the latest to the earliest; the border falls if at some time the two
        tokens that touch there had a merge of lower rank than the merge undone last.
        """
        bound = len(self._bytes) + 1
        while True:
            t = self.merged.get((x, y))
            if t is not None and t < bound:
                return False
            x_splits, y_splits = self.left[x] != x, self.left[y] != y
            if x_splits and (x > y or not y_splits):
                bound, x = x, self.right[x]
            elif y_splits:
                # equal ranks merge from the left, so the left side of a tie counts as earlier
                bound, y = y + 1, self.left[y]
            else:
                return True

    def follows(self, x: int, y: int) -> bool:
        key = (x, y)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MEMORY:
                self._pairs.clear()
            known = self._pairs[key] = self._adjacent(x, y)
        return known

    def last_token(self, data: bytes, last: list[int], end: int) -> int:
        """The last token of ``data[:end]``; ``last[i]`` holds that of ``data[:i]`` for ``0 < i < end``."""
        get, follows = self.ends.get, self.follows
        for start in range(end - 1, -1, -1):
            t = get(data[start:end])
            if t is None:
                break
            if t >= 0 and (not start or follows(last[start], t)):
                return t
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, data: bytes) -> list[int]:
        t = self.ranks.get(data)
        if t is not None:
            return [t]
        return PrefixTable(self, data).tokens()


class PrefixTable:
    """The table of last tokens of one byte string, kept exact under appends and edits."""

    def __init__(self, coder: PrefixCoder, data: bytes = b""):
        self.coder, self.data, self.last = coder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        begin = len(self.data) + 1
        self.data += more
        for end in range(begin, len(self.data) + 1):
            self.last.append(self.coder.last_token(self.data, self.last, end))

    def replace(self, start: int, stop: int, by: bytes) -> int:
        """Replace ``data[start:stop]``; returns how many entries were computed anew."""
        data = self.data[:start] + by + self.data[stop:]
        shift, last = len(data) - len(self.data), self.last[: start + 1]
        same = done = 0
        for end in range(start + 1, len(data) + 1):
            last.append(self.coder.last_token(data, last, end))
            done += 1
            same = same + 1 if end - shift > stop and last[end] == self.last[end - shift] else 0
            if same >= self.coder.longest:
                last += self.last[end - shift + 1 :]
                break
        self.data, self.last = data, last
        return done

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            t = self.last[at]
            out.append(t)
            at -= len(self.coder._bytes[t])
        return out[::-1]


class TextCoder(dict):
    """Units of text to their token ids as little-endian int32 bytes.

    A unit is a run of characters without white space with the one blank before it, or a run of white space; no
    pre-token crosses its borders, so units are encoded once and remembered.
    """

    _WS = r"[^\S\x1c-\x1f]"  # these four control characters are blanks for str, not for the vocabulary's pattern
    _UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
    _UNIT_CONTROL = re.compile(rf" ?[\S\x1c-\x1f]+|{_WS}+(?![\S\x1c-\x1f])|{_WS}+")
    _CONTROL = re.compile("[\x1c-\x1f]")

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.coder = PrefixCoder(ranks)
        self.pieces: dict[str, bytes] = {}
        self._piece = regex.compile(PATTERN)

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        found = self[unit] = b"".join(map(self._encode_piece, self._piece.findall(unit)))
        return found

    def _encode_piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) >= MEMORY:
                self.pieces.clear()
            known = np.array(self.coder.encode(piece.encode()), dtype="<i4").tobytes()
            if len(piece) < 200:
                self.pieces[piece] = known
        return known

    def units(self, text: str) -> list[str]:
        return (self._UNIT_CONTROL if self._CONTROL.search(text) else self._UNIT).findall(text)

    def encode_bytes(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.units(text))) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<i4").tolist()

    def count(self, text: str | None) -> int:
        return len(self.encode_bytes(text)) // 4


@lru_cache(maxsize=2)
def text_coder(path: str) -> TextCoder:
    """One coder for each worker process and vocabulary."""
    return TextCoder(load_ranks(path))


def encode_corpus(df: DataFrame, key: str, text: str, *, vocabulary: str | None = None) -> DataFrame:
    """Token ids of every row: columns ``key`` and ``ids`` (array<int>), one row for each input row.

    Special tokens are never produced: their strings are ordinary text. Null and empty texts give the empty list;
    a null key stays null; repeated rows stay repeated; other columns of ``df``, also one named ``ids``, are not read.
    Texts of any length are encoded whole. The work is one narrow pass without shuffle.
    """
    path = vocabulary or default_vocabulary()
    kind = df.schema[key].dataType
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                coded = [coder.encode_bytes(x) for x in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in coded)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["key", "ids"])

    return source.mapInArrow(run, f"key {kind.simpleString()}, ids array<int>").withColumnRenamed("key", key)


def token_counts(df: DataFrame, key: str, text: str, *, vocabulary: str | None = None) -> DataFrame:
    """Columns ``key`` and ``tokens`` (int): the length of each text in tokens, 0 for null and empty texts."""
    path = vocabulary or default_vocabulary()
    kind = df.schema[key].dataType
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_coder(path)
        for batch in batches:
            counts = pa.array([coder.count(x.as_py()) for x in batch.column(1)], type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], names=["key", "tokens"])

    return source.mapInArrow(run, f"key {kind.simpleString()}, tokens int").withColumnRenamed("key", key)
