"""Byte-level BPE encoding and decoding, linear in the length of a text.

A vocabulary of ranked byte strings gives the ids. A text is split by the
vocabulary's pattern; each piece is encoded for itself, and a piece that is a
token as a whole is that token. Otherwise

1. every byte is one Latin-1 character, and a pyahocorasick automaton of the
   reversed tokens, run over the reversed piece, yields the longest token that
   starts at each byte;
2. the piece is covered from the left, at each place by the longest token that
   may follow the one before it, else by the longest shorter one. Two tokens may
   stand side by side if the merges turn the bytes of both into just these two;
   that is worked out once for a pair and memoised;
3. where no token fits, the place is marked and the token before it is taken
   back for a shorter one. The ids of a prefix are unique, so a marked place is
   never entered again and each place is left backwards at most once.

A sequence whose neighbours all are compatible is the one that the merges give.
The pattern's classes are those of the ``regex`` module: code points that are
unassigned in the Unicode version of another library may be split otherwise there.
Pieces are memoised per Python worker. One narrow pass, nothing is shuffled.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from voltframe.llm.common import by_value, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Memoised pieces and pairs of a worker; the memo starts anew beyond them.
MEMO = 500_000
#: Texts up to this many characters are split at once, longer ones in parts.
SPLIT_CHARS = 1 << 20


def vocabulary_path(file: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(file)


class _Pieces(dict):
    """Ids of pieces, as little-endian unsigned 32-bit integers."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.bpe.piece_ids(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= 64:  # longer ones hardly come again
            if len(self) >= MEMO:
                self.clear()
            self[piece] = ids
        return ids


class ByteBpe:
    """``path``: lines of a base64 token and its rank; every byte must be a token."""

    def __init__(self, path: str):
        import ahocorasick
        import public_tokenizers
        import regex
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"{path}: bytes without a token: {missing}")
        self.token = dict(zip(self.rank.values(), self.rank))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.automaton = ahocorasick.Automaton()
        #: the next shorter token that begins a token, -1 for single bytes
        self.shorter: dict[int, int] = {}
        for token, rank in self.rank.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), rank)
            self.shorter[rank] = next((self.rank[token[:n]] for n in range(len(token) - 1, 0, -1)
                                       if token[:n] in self.rank), -1)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self)

    def merged(self, piece: bytes) -> list[int]:
        """Ids by the merges themselves, lowest rank and then leftmost first:
        quadratic, for the bytes of two tokens."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(a + b, len(self.rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(self.rank):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= MEMO:
                self.fits.clear()
            known = self.fits[left, right] = self.merged(self.token[left] + self.token[right]) == [left, right]
        return known

    def longest(self, piece: bytes) -> list[int]:
        """The longest token that starts at each byte."""
        found = [-1] * len(piece)
        last = len(piece) - 1
        for end, rank in self.automaton.iter(piece[::-1].decode("latin-1")):
            if found[last - end] < 0:  # longest first
                found[last - end] = rank
        return found

    def piece_ids(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        longest, token_of = self.longest(piece), self.token
        ids: list[int] = []
        stuck = bytearray(len(piece) + 1)
        at, token = 0, longest[0] if piece else -1
        while at < len(piece):
            while token >= 0:
                end = at + len(token_of[token])
                if not stuck[end] and (not ids or self.compatible(ids[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                ids.append(token)
                at = end
                token = longest[at] if at < len(piece) else -1
            else:
                stuck[at] = 1
                token = ids.pop()
                at -= len(token_of[token])
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32-bit."""
        pieces = self.pieces
        if len(text) <= SPLIT_CHARS:
            return b"".join([pieces[p] for p in self.pattern.findall(text)])
        matches, parts = self.pattern.finditer(text), []
        while part := [pieces[m.group()] for m in islice(matches, 100_000)]:
            parts.append(b"".join(part))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def _loaded(path: str) -> ByteBpe:
    return ByteBpe(path)


def encoded(text: Column, path: str | None = None) -> Column:
    """Ids of a string column, as binary: little-endian unsigned 32-bit integers.
    A null text counts as empty."""
    path = path or vocabulary_path()

    def encode(texts: list) -> pa.Array:
        bpe = _loaded(path)
        return pa.array([bpe.encode(t or "") for t in texts], type=pa.binary())
    return F.arrow_udf(by_value(encode), BinaryType())(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """Bytes of a binary column of ids; a null stays null."""
    path = path or vocabulary_path()

    def decode(rows: list) -> pa.Array:
        bpe = _loaded(path)
        return pa.array([None if r is None else bpe.decode(r) for r in rows], type=pa.binary())
    return F.arrow_udf(by_value(decode), BinaryType())(ids)


def bpe_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``ids`` (binary, see ``encoded``)
    and ``decoded`` (the bytes that the ids stand for, those of the text).

    A null or empty text has no ids and decodes to no bytes; repeated rows and
    null ids each keep their row; an empty table gives an empty result; further
    columns are ignored. Texts may have any length: memory follows one text."""
    ids = docs.select(F.col(id_col).alias("doc_id"), encoded(F.col(text_col), path).alias("ids"))
    return ids.select("doc_id", "ids", decoded(F.col("ids"), path).alias("decoded"))


def op12_byte_bpe(spark, sf_dir: str) -> DataFrame:
    got = bpe_round_trip(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
