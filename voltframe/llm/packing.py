"""Packing by power-of-two decomposition.

Each document's token ids are cut into pieces whose lengths are powers of two,
at most ``max_length``: as many full pieces as fit, then the binary digits of
the rest, largest first. Pieces of one length form a bucket; every piece is a
sequence of its own, so no sequence crosses documents and none needs padding.
A training job draws batches from one bucket at a time.

The work is one narrow pass: no shuffle, nothing gathered. Token ids of words
are memoised per Python worker (the first ``MEMO_WORDS`` words it meets; others
for one batch), since the tokenizer never joins across white space.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LENGTH = 4096
END_ID = 2
TOKENIZER_FILE = "word_bpe_49k.json"
MEMO_WORDS = 400_000


def tokenizer_path(file: str = TOKENIZER_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(file)


#: Characters whose lower case depends on their neighbours or has several parts.
_FOLDS_ELSEWHERE = "\u0130\u03a3"
#: A comma or full stop that belongs to a longer run of punctuation.
_PUNCTUATION_RUN = re.compile(r"(?:[^\w\s]|_)[.,] ")
_PLAIN = (string.ascii_letters + string.digits + string.whitespace).encode()


def _punctuation_runs(text: str) -> bool:
    """False only if every comma or full stop before a space follows a letter,
    a digit or white space."""
    if not text.isascii():
        return bool(_PUNCTUATION_RUN.search(text))
    marks = text.encode().translate(None, _PLAIN)
    return bool(marks.strip(b".,")) or any(run in text for run in ("..", ".,", ",.", ",,"))


class WordIds:
    """Token ids of whole texts for a tokenizer that drops white space and so
    never joins across it: ids of words between spaces, tabs and line feeds,
    memoised. Other white space stays inside a word, for the tokenizer."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memo_words = memo_words
        #: a word's number; its ids are ids[starts[number]:starts[number + 1]]
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(0, dtype="<u4")
        self.starts = np.zeros(1, dtype=np.int64)

    def learn(self, words: list[str]) -> None:
        """Encode unseen words in a few texts and share the ids out by offset."""
        ids, starts = [self.ids], [self.starts]
        total = len(self.ids)
        for at in range(0, len(words), 5_000):
            part = words[at:at + 5_000]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in part])
            begins = np.fromiter((o[0] for o in got.offsets), dtype=np.int64, count=len(got))
            starts.append(total + np.searchsorted(begins, ends))
            ids.append(np.array(got.ids, dtype="<u4"))
            total += len(got)
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words))))
        self.ids, self.starts = np.concatenate(ids), np.concatenate(starts)

    @staticmethod
    def words(text: str) -> list[str]:
        """Chunks of ``text`` that the tokenizer would never join. Case is
        folded here, where that commutes with the tokenizer's own folding, and a
        comma or full stop stands alone if it follows a letter or digit: both
        only make chunks recur more often."""
        if not any(c in text for c in _FOLDS_ELSEWHERE):
            text = text.lower()
        text = text.replace("\n", " ").replace("\t", " ")
        if not _punctuation_runs(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.words(t) for t in texts]
        unseen = [w for w in set().union(*split) if w not in self.memo]
        known = len(self.memo), len(self.ids)
        if unseen:
            self.learn(unseen)
        found = [self._gather(np.fromiter(map(self.memo.__getitem__, ws), dtype=np.int64, count=len(ws)))
                 for ws in split]
        if len(self.memo) > self.memo_words:  # full: what this call learnt is dropped again
            for w in unseen:
                del self.memo[w]
            self.ids, self.starts = self.ids[:known[1]].copy(), self.starts[:known[0] + 1].copy()
        return found

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the words, one after the other."""
        first, counts = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(counts)
        return self.ids[np.repeat(first - ends + counts, counts) + np.arange(ends[-1])]


def binary_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Full pieces of ``max_length`` (a power of two), then the binary digits
    of the remainder, largest first."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


_WORKER: dict[str, WordIds] = {}


def _pieces(batches: Iterator[pa.RecordBatch], path: str, max_length: int, end_id: int,
            with_ids: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encoder = _WORKER.get(path) or _WORKER.setdefault(path, WordIds(path))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows: dict[str, list] = {name: [] for name in schema.names}
            encoded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            for doc_id, own_ids in zip(part.column(0).to_pylist(), encoded):
                ids = np.append(own_ids, np.uint32(end_id)).astype("<u4")
                start = 0
                for length in binary_lengths(len(ids), max_length):
                    own = ids[start:start + length]
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(start)
                    rows["length"].append(length)
                    rows["ids_crc32"].append(zlib.crc32(own.tobytes()))
                    rows["doc_tokens"].append(len(ids))
                    if with_ids:
                        rows["ids"].append(own.astype(np.int32))
                    start += length
            yield pa.RecordBatch.from_pydict(rows, schema=schema)


def pack(docs: DataFrame, path: str | None = None, max_length: int = MAX_LENGTH, end_id: int = END_ID,
         with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    [ids,] sequence_id, offset``. ``length`` is also the bucket: write with
    ``partitionBy("length")`` to get the buckets as folders.

    A null or empty text is the end id alone (one piece of length 1). Null ids
    are kept as null; repeated rows are packed as often as they occur; an empty
    table gives no rows; further columns are ignored. ``sequence_id`` is unique
    in the result."""
    path = path or tokenizer_path()
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    pieces = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
              .mapInArrow(lambda b: _pieces(b, path, max_length, end_id, with_ids, schema), ddl))
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def op8_pack_pow2(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
