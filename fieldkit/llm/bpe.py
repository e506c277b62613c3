"""Byte-level BPE by prefix dynamic programming.

A sequence of tokens is what the merges give exactly if the merges leave every
pair of neighbours in it as it is. So each prefix of a byte string has one
valid last token: the one that is a suffix of the prefix and fits behind the
last token of what stands before it. ``Prefixes`` stores that token for every
prefix; the ids are read off backwards. Appending bytes only adds prefixes.
After an edit the stored tokens before it stay, and those behind it are taken
over again as soon as they repeat for as many bytes as the longest token has.

``EncodedText`` does the same for a whole text, whose matches of the pattern
are encoded one by one: an append splits anew from the last two matches, an
edit from two before it until a match begins where an old one did.

In Spark every batch looks its matches up in a table of those seen before; new
ones are sorted, so that a match goes on from the prefixes it shares with the one before.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import text_bytes, worker_cache

RANKS = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 700_000     # matches a worker keeps the ids of, about; then it starts anew
CACHE_PAIRS = 3_000_000    # and pairs of tokens
BLOCK = 1 << 21            # characters split at a time
FIRST = -1                 # stands before the first token


class Vocabulary:
    """Tokens by rank, which pairs of tokens may stand side by side, and the pattern texts are split by."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        # suffixes of tokens -> the tokens (id, length) that end like them, longest first
        suffixes = {t[k:] for t in ranks for k in range(len(t))}
        self.ends = {s: tuple((ranks[s[k:]], len(s) - k) for k in range(len(s)) if s[k:] in ranks) for s in suffixes}
        self.pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}, pattern)

    def merged(self, data: bytes) -> list[int]:
        """Ids of a short byte string by the merges themselves: the lowest rank first, the leftmost of equals."""
        parts = [data[k:k + 1] for k in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            found = [(ranks[both], k) for k in range(len(parts) - 1) if (both := parts[k] + parts[k + 1]) in ranks]
            if not found:
                break
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [ranks[p] for p in parts]

    def fits(self, before: int, token: int) -> bool:
        """Whether the merges leave this pair as it is (``FIRST``: the token alone)."""
        key = (before << 32) + token
        if key not in self.pairs:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            pair = [token] if before == FIRST else [before, token]
            self.pairs[key] = self.merged(b"".join(self.tokens[t] for t in pair)) == pair
        return self.pairs[key]

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Adds the last token of every prefix of ``data`` (up to ``stop`` bytes) longer than ``last`` holds."""
        ends, known, fits = self.ends, self.pairs, self.fits
        for i in range(len(last), len(data) if stop is None else stop):
            n, k = i + 1, i
            found = ends[data[i:n]]
            while k:
                k -= 1
                more = ends.get(data[k:n])
                if more is None:
                    break
                found = more
            for token, size in found:
                before = last[i - size] if size <= i else FIRST
                ok = known.get((before << 32) + token)
                if ok or (ok is None and fits(before, token)):
                    last.append(token)
                    break
            else:
                raise AssertionError("no token ends this prefix")

    def read(self, last: list[int]) -> list[int]:
        """The ids that the last tokens of all prefixes spell."""
        out, at, tokens = [], len(last), self.tokens
        while at:
            token = last[at - 1]
            out.append(token)
            at -= len(tokens[token])
        out.reverse()
        return out

    def piece_ids(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern: a token as a whole, or else what the merges give."""
        if data in self.ranks:
            return [self.ranks[data]]
        last: list[int] = []
        self.extend(data, last)
        return self.read(last)

    def pieces_ids(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each piece, in sorted order, with its ids as bytes; a piece goes on from the prefixes shared with the last."""
        before, last, ranks = b"", [], self.ranks
        for piece in sorted(pieces):
            if piece in ranks:
                yield piece, array("I", (ranks[piece],)).tobytes()
                continue
            shared, most = 0, min(len(before), len(piece))
            while shared < most and before[shared] == piece[shared]:
                shared += 1
            del last[shared:]
            self.extend(piece, last)
            before = piece
            yield piece, array("I", self.read(last)).tobytes()

    def split(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, a block of text at a time (the last two matches of a block may go on)."""
        at, size = 0, BLOCK
        while at < len(text):
            found = self.find(text, at, min(at + size, len(text))) if at or len(text) > size else self.find(text)
            if at + size < len(text):
                found = found[:-2]
                if not found:   # one match of a whole block
                    size *= 2
                    continue
                at += sum(map(len, found))
                size = BLOCK
            else:
                at = len(text)
            yield found

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids given as unsigned 32-bit integers."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, np.uint32).tolist()))


class Prefixes:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.worked = 0   # prefixes worked out so far
        self.append(data)

    def append(self, data: bytes) -> None:
        """More bytes at the end: the prefixes so far stay."""
        self.data += data
        self._extend(len(self.data))

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Other bytes in place of ``[start:end)``; behind them only prefixes whose last token may change are redone."""
        old, moved = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[:start]
        self._extend(min(len(self.data), start + len(data)))
        # a last token depends on the bytes and last tokens of one token's length before it
        same, at = 0, start + len(data)
        while at < len(self.data):
            self._extend(at + 1)
            same = same + 1 if self.last[at] == old[at - moved] else 0
            at += 1
            if same >= self.vocabulary.longest:
                self.last += old[at - moved:]
                break

    def _extend(self, stop: int) -> None:
        self.worked += max(0, stop - len(self.last))
        self.vocabulary.extend(self.data, self.last, stop)

    def ids(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.data)
        return self.vocabulary.read(self.last) if whole is None else [whole]


class EncodedText:
    """A text with its ids, kept exact under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, ""
        self.starts: list[int] = []
        self.pieces: list[Prefixes] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> None:
        """Other characters in place of ``[start:end)``."""
        moved = len(text) - (end - start)
        self.text = self.text[:start] + text + self.text[end:]
        first = max(0, bisect_right(self.starts, start) - 3)
        at = self.starts[first] if self.starts else 0
        old = {s + moved: k for k, s in enumerate(self.starts) if s >= end}
        starts, pieces, kept = [], [], len(self.starts)
        for piece in (p for block in self.vocabulary.split(self.text[at:]) for p in block):
            if at >= start + len(text) and at in old:   # the pattern never looks back: the rest is split as before
                kept = old[at]
                break
            starts.append(at)
            pieces.append(piece)
            at += len(piece)
        made, spare = [], self.pieces[first:kept]
        for k, piece in enumerate(pieces):
            made.append(self._piece(piece.encode(), spare[k] if k < len(spare) else None))
        self.starts = self.starts[:first] + starts + [s + moved for s in self.starts[kept:]]
        self.pieces = self.pieces[:first] + made + self.pieces[kept:]

    def _piece(self, data: bytes, old: Prefixes | None) -> Prefixes:
        """The match's prefixes, out of those of the match that stood in its place."""
        if old is None:
            return Prefixes(self.vocabulary, data)
        a = 0
        while a < min(len(data), len(old.data)) and data[a] == old.data[a]:
            a += 1
        b = 0
        while b < min(len(data), len(old.data)) - a and data[-1 - b] == old.data[-1 - b]:
            b += 1
        old.replace(a, len(old.data) - b, data[a:len(data) - b])
        return old

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p.ids()]


class Encoder:
    """Ids of whole texts, with a table of the matches seen before."""

    def __init__(self, vocabulary: Vocabulary, limit: int = CACHE_PIECES):
        self.vocabulary, self.limit = vocabulary, limit
        self.known: dict[str, bytes] = {}

    def _ids(self, blocks: list[list[str]]) -> list[bytes]:
        """The ids of each list of matches."""
        if len(self.known) > self.limit:
            self.known = {}
        known = self.known
        new = set().union(*blocks).difference(known)
        for piece, ids in self.vocabulary.pieces_ids([p.encode() for p in new]):
            known[piece.decode()] = ids
        return [b"".join(map(known.__getitem__, found)) for found in blocks]

    def of(self, texts: list[str], at_a_time: int = 500) -> Iterator[bytes]:
        """The ids of each text as unsigned 32-bit integers."""
        for k in range(0, len(texts), at_a_time):
            part = texts[k:k + at_a_time]
            short = [t for t in part if len(t) <= BLOCK]
            found = iter(self._ids([self.vocabulary.find(t) for t in short]))
            for t in part:
                yield next(found) if len(t) <= BLOCK else b"".join(
                    ids for block in self.vocabulary.split(t) for ids in self._ids([block]))


def vocabulary_of(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path and pattern:
        return path, pattern
    import public_tokenizers
    return path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN


def encoder(path: str | None, pattern: str | None) -> Encoder:
    """The worker's encoder: its tables outlive a task."""
    known = worker_cache("byte bpe")
    where = vocabulary_of(path, pattern)
    if where not in known:
        known[where] = Encoder(Vocabulary.load(*where))
    return known[where]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers).

    Null and empty texts have no ids; rows with null or repeated doc_ids are
    encoded like any other, each once; an empty table gives no rows; other
    columns are ignored. Bytes that are not UTF-8 count as U+FFFD.
    ``path``, ``pattern``: the ranks' file on the executors, and what texts are split by.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.decode("utf-8", "replace") for t in b.column("text").to_pylist()]
            ids = list(encoder(path, pattern).of(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return text_bytes(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for, to rows of doc_id, n_tokens, ids (null ids: null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = encoder(path, pattern).vocabulary.decode
            decoded = [None if i is None else of(i) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(decoded, pa.binary())],
                                             names=[*b.schema.names, "decoded"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{columns}, decoded binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes they decode to, per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = encoder(path, pattern)
            n, sums, back = [], [], []
            for ids in own.of([t.decode("utf-8", "replace") for t in b.column("text").to_pylist()]):
                n.append(len(ids) // 4)
                sums.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(own.vocabulary.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return text_bytes(docs, "doc_id").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
