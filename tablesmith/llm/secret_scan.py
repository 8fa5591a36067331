"""Secret scans: a keyword automaton finds where to look, anchored patterns decide, checksums confirm.

One Aho-Corasick automaton holds every keyword in every spelling that the
patterns accept, so the text is never lower-cased (which could move positions).
A pattern is tried only at the positions of its keyword, left to right, and a
match hides later starts inside it; that gives the leftmost non-overlapping
matches of the whole pattern. Runs of hex digits have no keyword: their pattern
is its own scan. Service tokens that carry a checksum (30 characters followed by
their CRC-32 in base 62) count only when it agrees.

Each text is handled whole and alone. Defined results: null and empty texts
hold nothing; a null id stays null; repeated rows give repeated results; extra
columns are ignored by ``find_secrets`` and kept by ``redact``.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import id_text, slices, worker_cache

#: Span kinds in the order in which ties on the start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "checked")

ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _spellings(word: str) -> Iterator[str]:
    return map("".join, itertools.product(*[{c.lower(), c.upper()} for c in word]))


def _automaton():
    cache = worker_cache()
    if "secret_keywords" not in cache:
        import ahocorasick
        found = ahocorasick.Automaton()
        for word in ASSIGN_WORDS:
            for spelling in _spellings(word):
                found.add_word(spelling, ("assign", len(word)))
        found.add_word("AKIA", ("access", 4))
        for word in CHECKED_PREFIXES:
            found.add_word(word, ("checked", len(word)))
        found.make_automaton()
        cache["secret_keywords"] = found
    return cache["secret_keywords"]


def _kept(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= ASSIGN_LEAST
    if kind == "access":
        return m.end() - m.start() >= ACCESS_LEAST
    return base62_crc(m[1]) == m[2]


PATTERNS = {"assign": ASSIGN, "access": ACCESS, "checked": CHECKED}


def secret_spans(text: str | None, automaton=None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start, then kind as listed."""
    if not text:
        return []
    starts: dict[str, list[int]] = {}
    for end, (kind, length) in (automaton or _automaton()).iter(text):
        starts.setdefault(kind, []).append(end - length + 1)
    out = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for kind, at in starts.items():
        past = 0
        for start in sorted(at):
            if start >= past and (m := PATTERNS[kind].match(text, start)):
                past = m.end()
                if _kept(kind, m):
                    out.append((kind, start, past))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: array of (kind, start, end) in code points, by start, then kind."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _automaton()
        for batch in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in secret_spans(t, words)]
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, type=pa.list_(kind))],
                                             names=["doc_id", "found"])

    return id_text(docs).mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def spans_text(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, comma-joined."""
    own = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with each span (overlapping ones as one) replaced by a placeholder naming its first kind."""
    if not spans:
        return text
    out, past, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[past:start], f"[{kind} removed]"]
        past, i = end, i + 1
    return "".join([*out, text[past:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets in ``text_col`` masked (and ``length_col``, if there, set to the new length)."""
    at, names = docs.columns.index(text_col), docs.columns
    length = names.index(length_col) if length_col in names else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _automaton()
        for batch in slices(batches, text_col):
            texts = [masked(t, secret_spans(t, words)) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, type=batch.schema.field(at).type)
            if length is not None:
                columns[length] = pa.array([None if t is None else len(t) for t in texts],
                                           type=batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
