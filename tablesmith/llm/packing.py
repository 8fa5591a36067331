"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: every task keeps at most ``open_bins`` sequences
open. A bitset holds one bit per amount of free space, so the tightest bin that
fits is one shift and one lowest-bit lookup away. When a new bin is needed and
all are open, the fullest one closes. Work and memory of a task do not depend
on the size of the corpus, and nothing is shuffled: a task packs the split that
it reads, and its sequence numbers start with its partition number.

Defined results: a null text is an empty one (one separator token); a null id
stays null; repeated rows are packed as often as they occur; extra columns are
ignored; an empty table gives no rows. Texts of any length are encoded whole.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tablesmith.llm.common import id_text, slices, worker_cache

SEQUENCE_TOKENS = 2048
OPEN_BINS = 512
SEPARATOR = 0
VOCABULARY = "byte_bpe_50k"
#: Runs without a space, or of spaces, beyond which the plain library call encodes a text.
LONG_RUN = 1000


class BestFit:
    """Bounded-space best-fit bins of ``capacity``; ``place`` gives (bin, offset)."""

    def __init__(self, capacity: int, max_open: int) -> None:
        self.capacity, self.max_open = capacity, max_open
        self.free_bits = 0                       # bit f: some open bin has f free
        self.bins: list[deque[int]] = [deque() for _ in range(capacity + 1)]
        self.open, self.made = 0, 0

    def _take(self, free: int) -> int:
        bins = self.bins[free]
        number = bins.popleft()
        if not bins:
            self.free_bits &= ~(1 << free)
        return number

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
            self.open -= 1
        else:
            number, free = self.made, self.capacity
            self.made += 1
        left = free - size
        if left:
            if self.open >= self.max_open:       # the fullest open bin closes
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
                self.open -= 1
            self.bins[left].append(number)
            self.free_bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pieces(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length): whole when it fits, else full pieces with the shorter one first."""
    first = n_tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


def _encoders(vocabulary: str):
    """The tokenizer file's library, and the same vocabulary as ranks for the fast path; loaded once per worker."""
    cache = worker_cache()
    if vocabulary not in cache:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        cache[vocabulary] = tokenizer, tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN,
                                                         mergeable_ranks=ranks, special_tokens={}), tuple(special)
    return cache[vocabulary]


def encode(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Token ids (uint32) as the ``tokenizers`` file gives them.

    The same vocabulary as ranks encodes several times faster and gives the
    same ids on Latin text (tested character by character); anything else,
    special-token strings and extreme runs go to the ``tokenizers`` library.
    """
    tokenizer, fast, special = _encoders(vocabulary)
    try:
        text.encode("latin-1")
        plain = not any(s in text for s in special) and " " * LONG_RUN not in text \
            and max(map(len, text.split(" "))) < LONG_RUN
    except UnicodeEncodeError:
        plain = False
    if plain:
        return np.asarray(fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), dtype="<u4")
    return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pack(docs: DataFrame, *, sequence_tokens: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS,
         separator: int = SEPARATOR, vocabulary: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``).

    ``with_ids=False`` leaves the ids out and keeps their checksum only.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = BestFit(sequence_tokens, open_bins), TaskContext.get().partitionId() << 40
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
        for batch in slices(batches):
            rows: list[tuple] = []
            ids: list[np.ndarray] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tokens = np.append(encode(text, vocabulary) if text else np.empty(0, "<u4"), np.uint32(separator)).astype("<u4")
                for k, (start, length) in enumerate(pieces(len(tokens), sequence_tokens)):
                    number, offset = bins.place(length)
                    own = tokens[start:start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(own), first + number, offset))
                    if with_ids:
                        ids.append(own)
            columns = [pa.array(c, type=t) for c, t in zip(zip(*rows), types)]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)
    return id_text(docs).mapInArrow(run, schema)
