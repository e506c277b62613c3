"""Language-model scores by logistic context mixing.

A text is scored as its lower-cased words, each closed by a space, and an end
mark. A byte is coded as the turns on its path in a Huffman tree of the
corpus, so frequent bytes take few binary decisions. Several predictors know,
for a context (the last byte, two, three, the word so far) and a node
of the tree, how often the training corpus turned right there.

Mixing has two layers, all in log odds. In the first, the predictors are
combined by weights that a gate picks; there are two such mixers, gated by the
place in the word and by how often the word so far was seen at the node. The
second combines the two by weights of the document's own: they are refined
online, after every ``STEP`` words, by a gradient step on the errors made. The
bits so coded add up to the score.

Words and contexts are counted over all training documents, by Spark, and no
two contexts share a count. Contexts of the last bytes are finite in number:
their tables are broadcast, with slots for twice the contexts counted. Words
so far grow with the corpus and are never gathered. Each block of documents lists
its words in buckets by their first three bytes, so that a bucket of all blocks,
summed up as a group, holds every word that goes on from a longer beginning,
and counts it exactly; up to three bytes, the word so far is a context of last
bytes. Every block meets the counts of its own words in a cogroup, with a
word's *chain*: how many training words still agree with it after each
decision, as far as other words do. Words travel as lists, so Spark moves a row per block
and bucket.

The weights of the first layer are fitted to all training words, each left
out of the counts that predict it: equal decisions are added up to one row with
its number, and Newton's method needs a few passes, of which each
gate gives a gradient and a Hessian.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import bucket_of, in_batches, save, worker_cache

FOLDS = 10
SLOT_BITS = (16, 18, 20)      # fewest slots of a table: last byte, 2 bytes, 3 bytes; each with a node
WIDEST = 3                    # bytes; longer beginnings of words are counted by group
GATES = 8                     # of each first-layer mixer
MIXERS = 2
STEP = 64                     # words between refinements of a document's weights
RATE = 0.0003
PASSES = 12                   # over the decisions, at most, to fit the weights
ENOUGH = 1e-5                 # share of the loss that a pass must still gain
GATHERED = 1_500_000          # decisions that a task adds up at a time
BLOCK_BYTES = 16 << 20        # documents are scored in blocks of about so much text
PARCEL_BYTES = 1 << 20        # and travel in parcels of so much
PART = 100_000                # words spelled out at a time
BATCH_TOKENS = 100_000        # words refined together, about
ADD = 0.1                     # added to each word count
END = b"\0"
_KNUTH = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    size = 1 << max(16, int(n).bit_length())
    known = worker_cache("powers")
    if size not in known:
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        known.clear()
        known[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return known[size]


def closed(words: list[bytes]) -> list[bytes]:
    """Words as they are coded: with the space that closes them; the empty word stands for the end mark."""
    return [w.replace(END, b"\1") + b" " if w else END for w in words]


@dataclass
class Symbols:
    """The bytes of closed words one after another, with their contexts."""
    data: np.ndarray
    word: np.ndarray      # which word
    place: np.ndarray     # place in the word
    last: np.ndarray      # the last three bytes
    so_far: np.ndarray    # hash of the word so far


def symbols_of(tokens: list[bytes]) -> Symbols:
    raw = np.frombuffer(b"".join(b"   " + t for t in tokens), np.uint8)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    word = np.repeat(np.arange(len(tokens)), size)
    first = np.cumsum(size) - size
    place = np.arange(word.size) - first[word]
    here = np.arange(word.size) + 3 * (word + 1)
    up, down = _powers(raw.size + 1)
    upto = np.zeros(raw.size + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:raw.size], out=upto[1:])
    start = here - place
    so_far = (upto[here] - upto[start]) * down[start]
    two = raw[here - 1].astype(np.uint64) | raw[here - 2].astype(np.uint64) << np.uint64(8)
    three = two | raw[here - 3].astype(np.uint64) << np.uint64(16)
    mixed = (so_far + np.uint64(1)) * _KNUTH
    return Symbols(raw[here], word, place, three, mixed ^ mixed >> np.uint64(32))


def huffman(counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Length and first place of each symbol's path; nodes and turns of all paths."""
    heap = [(int(c) + 1, s, [s]) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    node = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for turn, (_, _, below_it) in enumerate((a, b)):
            for s in below_it:
                paths[s].append((node, turn))
        heapq.heappush(heap, (a[0] + b[0], len(counts) + node, a[2] + b[2]))
        node += 1
    length = np.array([len(p) for p in paths])
    nodes = np.array([n for p in paths for n, _ in reversed(p)], np.int64)
    turns = np.array([t for p in paths for _, t in reversed(p)], bool)
    return length, np.cumsum(length) - length, nodes, turns


@dataclass
class Model:
    length: np.ndarray     # of each symbol's path
    first: np.ndarray      # where its path starts
    nodes: np.ndarray      # nodes of all paths
    turns: np.ndarray      # 1: right
    keys: list             # per context of last bytes: which stands in a slot
    tables: list           # ... and the log odds of a right turn
    sure: np.ndarray       # gate of the widest context, by slot
    weights: np.ndarray    # (MIXERS, GATES, contexts)


@dataclass
class Bits:
    """The binary decisions of closed words."""
    word: np.ndarray      # which word
    right: np.ndarray
    key: np.ndarray       # the last three bytes and the node
    so_far: np.ndarray    # hash of the word so far and the node
    place: np.ndarray     # gate of the first mixer


def bits_of(paths: tuple[np.ndarray, ...], s: Symbols, so_far: bool = False) -> Bits:
    length, first, nodes, turns = paths
    size = length[s.data]
    path = np.arange(size.sum()) + np.repeat(first[s.data] - (np.cumsum(size) - size), size)
    node = nodes[path].astype(np.uint64)
    key = np.repeat(s.last << np.uint64(8), size)
    key |= node
    own = np.repeat(s.so_far, size) ^ node * np.uint64(0xD6E8FEB86659FD93) if so_far else None
    return Bits(np.repeat(s.word, size), turns[path], key, own,
                np.repeat(np.minimum(s.place, GATES - 1).astype(np.int8), size))


def narrowed(key: np.ndarray) -> list[np.ndarray]:
    """The contexts of ``SLOT_BITS`` in the last three bytes with a node."""
    return [key & np.uint64((1 << 8 * (k + 1)) - 1) for k in range(WIDEST + 1 - len(SLOT_BITS), WIDEST + 1)]


def placed(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """An open table of 2^bits slots with the distinct keys, and the slot of each."""
    table = np.zeros(1 << bits, np.uint64)
    h = (key + np.uint64(1)) * _KNUTH          # one to one, and never 0
    at = (h >> np.uint64(64 - bits)).astype(np.int64)
    left = np.arange(h.size)
    while left.size:
        free = left[table[at[left]] == 0]
        table[at[free]] = h[free]
        left = left[table[at[left]] != h[left]]
        at[left] = (at[left] + 1) & (table.size - 1)
    return table, at


def find(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The slot of each key; of one that is not there, an empty slot."""
    h = (key + np.uint64(1)) * _KNUTH
    at = (h >> np.uint64(65 - table.size.bit_length())).view(np.int64)
    got = table.take(at)
    left = np.flatnonzero((got != h) & (got != 0))
    while left.size:
        at[left] = (at[left] + 1) & (table.size - 1)
        got = table[at[left]]
        left = left[(got != h[left]) & (got != 0)]
    return at


def odds(ones: np.ndarray, seen: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.4)) / (seen - ones + np.float32(0.4)))


def sureness(seen: np.ndarray) -> np.ndarray:
    """0 for never seen, then a gate for every factor of 8."""
    return np.minimum(np.ceil(np.log2(np.maximum(seen, 0) + 1) / 3), GATES - 1).astype(np.int8)


def tables_of(key: np.ndarray, seen: np.ndarray, ones: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per context of last bytes its open table, and per slot how often it was seen, and turned right."""
    out = []
    for own, least in zip(narrowed(key.astype(np.uint64)), SLOT_BITS, strict=True):
        some, which = np.unique(own, return_inverse=True)
        table, at = placed(some, max(least, (2 * some.size).bit_length()))
        n, r = np.zeros(table.size, np.float32), np.zeros(table.size, np.float32)
        n[at] = np.bincount(which, weights=seen, minlength=some.size)
        r[at] = np.bincount(which, weights=ones, minlength=some.size)
        out.append((table, n, r))
    return out


def build(paths: tuple[np.ndarray, ...], key: np.ndarray, seen: np.ndarray, ones: np.ndarray, tables: list,
          weights: np.ndarray) -> Model:
    """The model of context counts, or of their ``tables`` if there; even weights if none are given."""
    tables = tables or tables_of(key, seen, ones)
    even = np.full((MIXERS, GATES, len(SLOT_BITS) + 1), 0.3)
    return Model(*paths, [t for t, _, _ in tables], [odds(r, n) for _, n, r in tables], sureness(tables[-1][1]),
                 weights if weights.size else even)


def unrolled(bits: np.ndarray, counts: np.ndarray, sizes: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seen, same) at each decision of words with ``bits`` of them beyond WIDEST bytes: the training words that
    come there, and those that turn as this one does."""
    left = np.repeat(counts, bits + 1)
    first = np.cumsum(bits + 1) - (bits + 1)
    left[np.arange(chain.size) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)] = chain
    return np.delete(left, first + bits), np.delete(left, first)


def mixed_words(model: Model, tokens: list[bytes], counts: np.ndarray | None = None, sizes: np.ndarray | None = None,
                chain: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """(per mixer the log odds of the turns taken, bounds of each token's decisions); without counts and chains, words
    are unknown beyond WIDEST bytes. Contexts of last bytes are looked up once for equal bytes behind equal ones."""
    if counts is None:
        counts, sizes, chain = np.zeros(len(tokens)), np.zeros(len(tokens), np.int64), np.zeros(0)
    spelled = Spelled((model.length, model.first, model.nodes, model.turns), tokens)
    owner, place = _stretch(np.zeros(len(tokens), np.int64), spelled.size)
    at = spelled.start[owner] + place
    grams = pa.array(spelled.last(at, place) << 8 | spelled.data[at]).dictionary_encode()
    gram, kind = grams.indices.to_numpy(), grams.dictionary.to_numpy()
    del owner, at, grams
    # the decisions of each kind of byte: log odds from its last bytes, of the turn taken, and how sure they are
    size = model.length[kind & 255]
    which = np.repeat(np.arange(kind.size), size)
    path = np.arange(which.size) - np.repeat(np.cumsum(size) - size, size) + model.first[kind & 255][which]
    key = (kind >> 8 << 8)[which].view(np.uint64) | model.nodes[path].astype(np.uint64)
    sign = np.where(model.turns[path], np.float32(1), np.float32(-1))
    near = []
    for table, keys, own in zip(model.tables, model.keys, narrowed(key), strict=True):
        slot = find(keys, own)
        near.append(table.take(slot, mode="clip") * sign)
    near_sure = model.sure.take(slot)
    del which, path, key, sign, slot
    first = (np.cumsum(size) - size).astype(np.int32)
    n = size[gram]
    ends = np.cumsum(spelled.size)
    bound = np.concatenate([[0], np.concatenate([[0], np.cumsum(n)])[ends]])
    links = np.concatenate([[0], np.cumsum(sizes)])
    out = [np.empty(bound[-1], np.float32) for _ in range(MIXERS)]
    weights = model.weights.astype(np.float32)
    for k in range(0, len(tokens), 5_000):
        end = min(k + 5_000, len(tokens))
        own = slice(ends[k] - spelled.size[k], ends[end - 1])    # bytes
        rows = slice(bound[k], bound[end])
        m = n[own]
        pick = np.arange(rows.stop - rows.start, dtype=np.int32)
        pick += np.repeat(first[gram[own]] - (np.cumsum(m) - m).astype(np.int32), m)
        gate = np.repeat(np.minimum(place[own], GATES - 1), m)
        deep = np.flatnonzero(gate >= WIDEST)
        word = np.repeat(np.arange(end - k), spelled.size[k:end])
        bits = np.bincount(word, weights=m * (place[own] >= WIDEST), minlength=end - k).astype(np.int64)
        seen, same = unrolled(bits, counts[k:end], sizes[k:end], chain[links[k]:links[end]])
        xs = [x.take(pick, mode="clip") for x in near]
        so_far = xs[-1].copy()
        so_far[deep] = odds(same, seen)
        sure = near_sure.take(pick, mode="clip").astype(np.intp)
        sure[deep] = sureness(seen)
        for c, x in enumerate([*xs, so_far]):
            for mixer, g in enumerate((gate, sure)):
                part = weights[mixer, :, c].take(g, mode="clip")
                part *= x
                if c:
                    out[mixer][rows] += part
                else:
                    out[mixer][rows] = part
    return out, bound


def refine(z: list[np.ndarray], bound: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document (an array of token numbers, at least one)."""
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    order = np.argsort(-size, kind="stable")
    size = size[order]
    first, last = z
    bound = bound.astype(np.int32)
    w = np.full((2, len(docs)), 0.5, np.float32)
    logp = np.zeros(len(docs))
    for at in range(0, int(size[0]), STEP):
        live = int(np.searchsorted(-size, -at, side="left"))     # documents with words left
        tokens = np.concatenate([docs[k][at:at + STEP] for k in order[:live]])
        n = bound[tokens + 1] - bound[tokens]
        upto = np.cumsum(n, dtype=np.int32)
        bit = np.arange(upto[-1], dtype=np.int32)
        bit += np.repeat(bound[tokens] - (upto - n), n)
        words = np.minimum(size[:live] - at, STEP)
        starts = np.concatenate([[0], upto])[np.cumsum(words) - words]
        span = np.diff(np.append(starts, upto[-1]))
        a, b = first.take(bit, mode="clip"), last.take(bit, mode="clip")
        e = np.repeat(-w[0, :live], span)
        e *= a
        more = np.repeat(w[1, :live], span)
        more *= b
        e -= more
        np.exp(e, out=e)           # odds of the turns not taken
        miss = e + np.float32(1)
        logp[:live] -= np.add.reduceat(np.log(miss), starts, dtype=np.float64)
        np.divide(e, miss, out=miss)
        a *= miss
        b *= miss
        w[0, :live] += RATE * np.add.reduceat(a, starts)
        w[1, :live] += RATE * np.add.reduceat(b, starts)
    back = np.empty(len(docs))
    back[order] = logp
    return back


def counted(docs: DataFrame, buckets: int) -> DataFrame:
    """One pass over the documents: rows with ``docs`` (some documents of a block, packed) and rows with ``words`` (those
    of a block that fall into ``bucket``, and their counts in its training documents; the empty word is the end)."""
    held = F.coalesce(bucket_of("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out")
    base = docs.select("doc_id", held, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        held: list[tuple[pa.Array, np.ndarray]] = []     # distinct words of parts of the block, and their counts
        size = 0

        def rows(length: int, **cols) -> pa.RecordBatch:
            out = {"block": pa.array(np.full(length, block, np.int64)), "bucket": pa.nulls(length, pa.int32()),
                   "words": pa.nulls(length, pa.list_(pa.binary())), "counts": pa.nulls(length, pa.list_(pa.int64())),
                   "docs": pa.nulls(length, pa.binary())} | cols
            return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

        def count(part: pa.RecordBatch) -> None:
            found, at = split_words(part.column("text"))
            learned = ~part.column("held_out").to_numpy(zero_copy_only=False)
            n = np.bincount(found.indices.to_numpy(), weights=np.repeat(learned, np.diff(at)), minlength=len(found.dictionary))
            n[np.asarray(pc.equal(found.dictionary, b""), bool)] = 0
            held.append((found.dictionary, n))
            held.append((pa.array([b""], pa.binary()), np.array([np.count_nonzero(learned)])))   # an end each

        def vocabulary() -> pa.RecordBatch:
            found = pa.concat_arrays([w for w, _ in held]).dictionary_encode()
            n = np.bincount(found.indices.to_numpy(), weights=np.concatenate([c for _, c in held])).astype(np.int64)
            order, at = in_order(found.dictionary, buckets)
            some, first = np.unique(at, return_index=True)
            bounds = pa.array(np.append(first, order.size).astype(np.int32))
            return rows(some.size, bucket=pa.array(some.astype(np.int32)),
                        words=pa.ListArray.from_arrays(bounds, found.dictionary.take(pa.array(order))),
                        counts=pa.ListArray.from_arrays(bounds, pa.array(n[order])))

        for b in batches:
            upto = np.cumsum(pc.binary_length(b.column("text")).to_numpy().astype(np.int64))
            first, done = 0, 0
            while first < b.num_rows:
                # documents up to the end of the block, or of the batch
                end = min(b.num_rows, int(np.searchsorted(upto, done + BLOCK_BYTES - size, side="right")) + 1)
                part = b.slice(first, end - first)
                count(part)
                parcel = (upto[first:end] - done) // PARCEL_BYTES
                for own in np.split(np.arange(first, end), np.flatnonzero(np.diff(parcel)) + 1):
                    cut = b.slice(own[0], own.size)
                    yield rows(1, docs=pa.array([packed(**{c: cut.column(c) for c in ("doc_id", "held_out", "text")})], pa.binary()))
                size += int(upto[end - 1]) - done
                first, done = end, int(upto[end - 1])
                if size > BLOCK_BYTES:
                    yield vocabulary()
                    block, size, held = block + 1, 0, []
        if held:
            yield vocabulary()

    return save(base.mapInArrow(run, "block bigint, bucket int, words array<binary>, counts array<bigint>, docs binary"), "counted")


_MADE = ["turn", "seen", "same"]


def _added(tables: list[pa.Table]) -> pa.Table:
    """Equal decisions as one row with their number ``n``."""
    out = pa.concat_tables(tables).group_by(_MADE).aggregate([("n", "sum")])
    return out.rename_columns([*_MADE, "n"])


class Made:
    """The decisions made by training words, each kind with its number; few are held apart at a time."""

    def __init__(self):
        self.tables = [pa.table({c: pa.array([], pa.int64()) for c in [*_MADE, "n"]})]

    def add(self, last: np.ndarray, node: np.ndarray, place: np.ndarray, right: np.ndarray, seen: np.ndarray, same: np.ndarray) -> None:
        key = last.astype(np.int64) << 8 | node
        turn = key << 4 | np.minimum(place, GATES - 1) << 1 | right
        self.tables.append(pa.table({"turn": turn, "seen": seen, "same": same, "n": np.ones(turn.size, np.int64)}))
        if sum(map(len, self.tables[1:])) > GATHERED // 4:
            self.tables = [_added(self.tables)]

    def table(self) -> pa.Table:
        return _added(self.tables).combine_chunks()


class Spelled:
    """Closed words as bytes, and the decisions of stretches of them."""

    def __init__(self, paths: tuple[np.ndarray, ...], tokens: list[bytes]):
        self.length, self.first, self.nodes, self.turns = paths
        self.data = np.frombuffer(b"   " + b"".join(tokens), np.uint8)
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.size) - self.size + 3

    def last(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The three bytes before each; spaces before a word's own."""
        out = np.zeros(at.size, np.int64)
        for k in (1, 2, 3):
            out |= np.where(place >= k, self.data[at - k], 32).astype(np.int64) << 8 * (k - 1)
        return out

    def bits(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which byte, node, right) of the decisions of the bytes at these places."""
        size = self.length[self.data[at]]
        which = np.repeat(np.arange(at.size), size)
        path = np.arange(which.size) - np.repeat(np.cumsum(size) - size, size) + self.first[self.data[at]][which]
        return which, self.nodes[path], self.turns[path].astype(np.int64)


def _stretch(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number) of all numbers of the ranges [first, first + size)."""
    owner = np.repeat(np.arange(first.size), size)
    return owner, np.arange(owner.size) - np.repeat(np.cumsum(size) - size - first, size)


def chains(paths: tuple[np.ndarray, ...], tokens: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """(sizes, chain, decisions) of closed words, all that share their first WIDEST bytes with one of them.

    A word's chain: the training words that agree with it after WIDEST bytes and after each further decision, as
    long as they are more than its own. The decisions made by training words, (turn, seen, same) with the number of
    each kind: ``turn`` holds the last bytes, node, place and turn; ``seen`` is -1 within the first WIDEST bytes,
    where other groups add to ``same``.

    Words go byte by byte in groups that share all bytes so far; a word that is alone in its group has no chain from there.
    """
    counts = counts.astype(np.int64)
    words, made = Spelled(paths, tokens), Made()
    near: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(0, len(tokens), PART):
        own = np.arange(k, min(k + PART, len(tokens)))
        owner, place = _stretch(np.zeros(own.size, np.int64), np.minimum(words.size[own], WIDEST))
        at = words.start[own][owner] + place
        which, node, right = words.bits(at)
        kinds, inverse = np.unique((words.last(at, place)[which] << 8 | node) << 3 | place[which] << 1 | right, return_inverse=True)
        near.append((kinds, np.bincount(inverse, weights=counts[own][owner][which], minlength=kinds.size)))
    if near:
        kinds, inverse = np.unique(np.concatenate([u for u, _ in near]), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate([c for _, c in near])).astype(np.int64)
        kinds, n = kinds[n > 0], n[n > 0]
        made.add(kinds >> 11, kinds >> 3 & 255, kinds >> 1 & 3, kinds & 1, np.full(kinds.size, -1), n)

    long = np.flatnonzero(words.size > WIDEST)
    head = words.data[words.start[long][:, None] + np.arange(WIDEST)].astype(np.int64) @ (1 << 8 * np.arange(WIDEST))
    order = np.argsort(head, kind="stable")
    long, group = long[order], np.unique(head[order], return_inverse=True)[1]
    link_word, link = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    edges = np.flatnonzero(np.diff(group, prepend=-1))      # where groups begin
    upto = 0
    while upto < long.size:
        # whole groups, about PART words at a time
        k = np.searchsorted(edges, upto + PART)
        end = long.size if k == edges.size else int(edges[k])
        for w, v in _deep(words, long[upto:end], group[upto:end], counts, made):
            link_word.append(w)
            link.append(v)
        upto = end
    owner, value = np.concatenate(link_word), np.concatenate(link)
    order = np.argsort(owner, kind="stable")
    return np.bincount(owner, minlength=len(tokens)), value[order], made.table()


def _deep(words: Spelled, live: np.ndarray, group: np.ndarray, counts: np.ndarray, made: Made) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, training words that agree) for the links of the words ``live``, in the order of the decisions."""
    group = np.unique(group, return_inverse=True)[1]
    agree = np.bincount(group, weights=counts[live]).astype(np.int64)[group]
    more = agree > counts[live]
    yield live[more], agree[more]
    place = WIDEST
    while live.size:
        members = np.bincount(group)[group]
        total = np.bincount(group, weights=counts[live])[group]
        lone = live[(members == 1) & (total > 0)]
        for k in range(0, lone.size, PART // 4):    # nobody else comes here: seen and same are the word's own
            own = lone[k:k + PART // 4]
            owner, at = _stretch(words.start[own] + place, words.size[own] - place)
            which, node, right = words.bits(at)
            where = (at - words.start[own][owner])
            n = counts[own][owner][which]
            made.add(words.last(at, where)[which], node, where[which], right, n, n)
        stay = (members > 1) & (total > 0)
        live, group = live[stay], group[stay]
        if not live.size:
            break
        at = words.start[live] + place
        which, node, right = words.bits(at)
        kind, one, inverse = np.unique((group[which] << 8 | node) << 1 | right, return_index=True, return_inverse=True)
        same = np.bincount(inverse, weights=counts[live][which]).astype(np.int64)
        _, context = np.unique(kind >> 1, return_inverse=True)
        seen = np.bincount(context, weights=same).astype(np.int64)[context]
        some = same > 0
        one = one[some]
        where = np.full(one.size, place)
        made.add(words.last(at[which[one]], where), node[one], where, right[one], seen[some], same[some])
        agree = same[inverse]
        more = agree > counts[live][which]
        yield live[which[more]], agree[more]
        place += 1
        on = words.size[live] > place
        group = np.unique((group << 8 | words.data[at])[on], return_inverse=True)[1]
        live = live[on]


def packed(**columns: pa.Array) -> bytes:
    """Columns of equal length as one compressed value, so that Spark moves and holds them as they are."""
    batch = pa.record_batch(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def summed(rows: DataFrame, paths: tuple[np.ndarray, ...]) -> DataFrame:
    """(block, bucket, words): for the words of each block in a bucket, in order, their counts over all blocks and their
    chains, packed; and, with a null block, the number of training words and their decisions (turn, seen, same, n), packed."""
    def run(t: pa.Table) -> pa.Table:
        words = t.column("words").combine_chunks()
        coded = words.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        total = np.bincount(at, weights=t.column("counts").combine_chunks().flatten().to_numpy(),
                            minlength=len(coded.dictionary)).astype(np.int64)
        size, chain, made = chains(paths, closed(coded.dictionary.to_pylist()), total)
        links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(chain))
        bounds = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())])
        lists = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = pa.array(at[a:b])
            lists.append(packed(counts=pa.array(total[at[a:b]]), chain=links.take(own)))
        made = packed(**dict(zip(made.column_names, (c.combine_chunks() for c in made.columns), strict=True)))
        return pa.table({
            "block": pa.chunked_array([*t.column("block").chunks, pa.nulls(1, pa.int64())]),
            "bucket": pa.chunked_array([*t.column("bucket").chunks, pa.nulls(1, pa.int32())]),
            "words": pa.array([*lists, None], pa.binary()),
            "known": pa.array([None] * len(lists) + [np.count_nonzero(total)], pa.int64()),
            "made": pa.array([None] * len(lists) + [made], pa.binary())})

    return save(rows.select("block", "bucket", "words", "counts").groupBy("bucket").applyInArrow(
        run, "block bigint, bucket int, words binary, known bigint, made binary"), "vocabulary")


def decisions(totals: DataFrame) -> DataFrame:
    """(turn, seen, same, n): the decisions of the training words, equal ones of a task as one row with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for value in b.column("made"):
                held.append(unpacked(value.as_py()))
                size += len(held[-1])
                if size > GATHERED:
                    yield from _added(held).combine_chunks().to_batches()
                    held, size = [], 0
        if size:
            yield from _added(held).combine_chunks().to_batches()

    return save(totals.select("made").mapInArrow(run, "turn bigint, seen bigint, same bigint, n bigint"), "decisions")


def byte_counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How often each byte comes in the training words as coded; all training tokens (257 rows reach the driver)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(257)
        for batch in batches:
            words, n = batch.column("words").flatten(), batch.column("counts").flatten().to_numpy()
            at, data = _buffers(words)
            size = np.diff(at)
            table[:256] += np.bincount(data[at[0]:at[-1]], weights=np.repeat(n, size), minlength=256)
            table[32] += n[size > 0].sum()      # the space that closes a word
            table[256] += n.sum()
        ends = table[256] - table[32]
        table[1] += table[0]                    # as ``closed`` writes it
        table[0] = ends
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257)), pa.array(table)], names=["b", "n"])
    found = rows.select("words", "counts").mapInArrow(run, "b bigint, n double").groupBy("b").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(257)
    for r in found:
        out[r["b"]] = r["n"]
    return out[:256], int(out[256])


def slopes(made: pa.Table, tables: list, weights: np.ndarray) -> np.ndarray:
    """Per mixer and gate the loss of decisions, its gradient and its Hessian, one after another; of each decision
    one occurrence is taken back from the counts."""
    turn, seen, same, n = (made.column(c).to_numpy() for c in ("turn", "seen", "same", "n"))
    right = (turn & 1).astype(bool)
    place = (turn >> 1 & 7).astype(np.int8)
    x = []
    for (keys, often, ones), key in zip(tables, narrowed((turn >> 4).view(np.uint64)), strict=True):
        at = find(keys, key)
        s = often[at].astype(np.float64)
        x.append(odds(np.maximum(np.where(right, ones[at], s - ones[at]) - 1, 0), np.maximum(s - 1, 0)))
    x.append(np.where(seen < 0, x[-1], odds(same - 1, np.maximum(seen, same) - 1)))
    sure = sureness(np.where(seen < 0, s, seen) - 1)
    weight = (same * n).astype(np.float64)
    c = len(x)
    out = np.zeros((MIXERS, GATES, 1 + c + c * c))
    for m, g in enumerate((place, sure)):
        z = sum(weights[m, :, k][g] * x[k] for k in range(c))
        miss = 1 / (1 + np.exp(np.clip(z, -30, 30)))
        add = lambda v: np.bincount(g, weights=v, minlength=GATES)  # noqa: B023, E731
        out[m, :, 0] = add(weight * np.logaddexp(0, -z))
        for i in range(c):
            out[m, :, 1 + i] = add(weight * miss * x[i])
            for j in range(i + 1):
                both = add(weight * miss * (1 - miss) * x[i] * x[j])
                out[m, :, 1 + c + i * c + j] = out[m, :, 1 + c + j * c + i] = both
    return out


def fitted(made: DataFrame, tables: list) -> np.ndarray:
    """First-layer weights by Newton's method on all decisions; a step that loses is halved. Sums reach the driver."""
    spark = made.sparkSession
    shared = spark.sparkContext.broadcast(tables)
    c = len(tables) + 1
    weights = np.full((MIXERS, GATES, c), 0.3)
    best = weights.copy()
    least = np.full((MIXERS, GATES), np.inf)
    step = np.zeros_like(weights)
    for _ in range(PASSES):
        now = weights.copy()

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            out = np.zeros((MIXERS, GATES, 1 + c + c * c))
            for t in in_batches(batches, 200_000):
                out += slopes(t, shared.value, now)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], names=["k", "v"])

        sums = np.zeros((MIXERS, GATES, 1 + c + c * c))
        for r in made.mapInArrow(run, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
            sums.flat[r["k"]] = r["v"]
        before = least.sum()
        for m in range(MIXERS):
            for g in range(GATES):
                loss, grad, hess = sums[m, g, 0], sums[m, g, 1:1 + c], sums[m, g, 1 + c:].reshape(c, c)
                if loss <= least[m, g]:
                    least[m, g], best[m, g] = loss, now[m, g]
                    step[m, g] = np.linalg.solve(hess + (1e-6 * np.trace(hess) + 1e-9) * np.eye(c), grad)
                else:
                    step[m, g] /= 2
                weights[m, g] = best[m, g] + step[m, g]
        if before - least.sum() <= ENOUGH * least.sum():   # nothing is gained any more
            break
    shared.destroy()
    return best


def train(totals: DataFrame, paths: tuple[np.ndarray, ...]) -> Model:
    """The model of the training words. The contexts of last bytes reach the driver."""
    made = decisions(totals)
    often = F.col("same") * F.col("n")
    found = (made.groupBy(F.shiftright("turn", 4).alias("key"))
             .agg(F.sum(often).cast("double").alias("seen"),
                  F.sum(F.when(F.col("turn").bitwiseAND(1) == 1, often).otherwise(0)).cast("double").alias("ones")).toArrow())
    tables = tables_of(*[found.column(c).to_numpy() for c in ("key", "seen", "ones")])
    none = np.zeros(0)
    return build(paths, none, none, none, tables, fitted(made, tables))


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a binary array."""
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64), data


def in_order(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bucket): words by the bucket of their first bytes, then by their bytes (neighbours have much of their
    chains in common, which packs well), and the bucket of each in that order."""
    at, data = _buffers(words)
    size = np.minimum(np.diff(at), WIDEST)
    head = size << 8 * WIDEST
    for k in range(WIDEST):
        own = np.flatnonzero(size > k)
        head[own] |= data[at[own] + k].astype(np.int64) << 8 * k
    some, which = np.unique(head, return_inverse=True)
    crc = np.array([zlib.crc32(int(h).to_bytes(8, "little")[:h >> 8 * WIDEST].replace(END, b"\1")) for h in some.tolist()], np.int64)
    order = pc.sort_indices(words).to_numpy().astype(np.int64)
    bucket = (crc % buckets)[which][order]
    by = np.argsort(bucket, kind="stable")
    return order[by], bucket[by]


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-cased words of binary texts, numbered, and where each text's begin (a text may begin or end with an empty one)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    at = lists.offsets.to_numpy().astype(np.int64)
    found = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
    return pa.DictionaryArray.from_arrays(found.indices, found.dictionary.view(pa.binary())), at - at[0]


def numbered(texts: pa.ChunkedArray, buckets: int) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """The distinct words of the texts in order, with the end mark; each text as their numbers; and its bytes as coded."""
    found, at = split_words(pa.concat_arrays(texts.chunks))
    words = found.dictionary
    if not pc.any(pc.equal(words, b"")).as_py():
        words = pa.concat_arrays([words, pa.array([b""], pa.binary())])
    order, _ = in_order(words, buckets)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    size = pc.binary_length(words).to_numpy().astype(np.int64)[order]
    end = int(np.flatnonzero(size == 0)[0])
    ids = place[found.indices.to_numpy()]
    real = ids != end
    upto = np.concatenate([[0], np.cumsum(real)])[at]
    n_bytes = np.concatenate([[0], np.cumsum((size[ids] + 1) * real)])[at]
    ids = ids[real]
    docs = [np.append(ids[a:b], end) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
    return words.take(pa.array(order)).to_pylist(), docs, np.diff(n_bytes) + 1


def score_block(words: list[bytes], docs: list[np.ndarray], counts: np.ndarray, sizes: np.ndarray, chain: np.ndarray,
                model: Model, n: int, v: int) -> tuple:
    """(tokens, known tokens, base score, score) of each text of a block, given its words' counts and chains."""
    z, bound = mixed_words(model, closed(words), counts, sizes, chain)
    log_count = np.log10(counts + ADD)
    known = (counts > 0).astype(np.int64)
    tokens = np.fromiter(map(len, docs), np.int64, len(docs))
    flat, first = np.concatenate(docs), np.cumsum(tokens) - tokens
    base, hits = np.add.reduceat(log_count[flat], first), np.add.reduceat(known[flat], first)
    part = np.cumsum(tokens) // BATCH_TOKENS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(docs)]
    score = np.concatenate([refine(z, bound, docs[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b])
    return tokens, hits, base - tokens * np.log10(n + ADD * (v + 1)), score


def lm_scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes and bits_per_byte.

    Scores are log10 probabilities of the whole lower-cased text. Null and
    empty texts hold the end token alone; rows without a doc_id are learned
    from; repeated rows are counted and scored each; an empty table gives no
    rows; without training documents all predictors are even; other columns
    are ignored.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = counted(docs, buckets)
    listed = rows.where("bucket IS NOT NULL")
    bytes_seen, n = byte_counts(listed)
    paths = huffman(bytes_seen)
    vocabulary = summed(listed, paths)
    totals = vocabulary.where("block IS NULL")
    v = totals.agg(F.sum("known")).first()[0] or 0
    # contexts of last bytes only; plain arrays, as a broadcast names classes instead of carrying them
    shared = spark.sparkContext.broadcast(dict(vars(train(totals, paths))))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(parcels: pa.Table, known: pa.Table) -> pa.Table:
        own = pa.concat_tables(unpacked(p.as_py()) for p in parcels.column("docs"))
        words, docs, nbytes = numbered(own.column("text"), buckets)
        lists = [unpacked(w.as_py()) for w in known.sort_by("bucket").column("words")]
        counts = np.concatenate([t.column("counts").to_numpy() for t in lists])
        links = [c for t in lists for c in t.column("chain").chunks]
        sizes = np.concatenate([c.value_lengths().to_numpy() for c in links])
        chain = np.concatenate([c.flatten().to_numpy() for c in links])
        del lists, links   # the chains are the largest part, and copied now
        tokens, hits, base, logp = score_block(words, docs, counts.astype(np.float64), sizes.astype(np.int64), chain,
                                               Model(**shared.value), n, v)
        return pa.table({
            "doc_id": own.column("doc_id"), "held_out": own.column("held_out"), "n_tokens": pa.array(tokens),
            "n_known": pa.array(hits), "train_tokens": pa.array(np.full(len(tokens), n, np.int64)),
            "base_score": pa.array(base), "score": pa.array(logp / np.log(10)), "n_bytes": pa.array(nbytes),
            "bits_per_byte": pa.array(-logp / np.log(2) / nbytes)})

    words = vocabulary.where("block IS NOT NULL").select(F.col("block").alias("of_block"), "bucket", "words")
    return (rows.where("docs IS NOT NULL").select("block", "docs").groupBy("block")
            .cogroup(words.groupBy("of_block"))
            .applyInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
                                 "train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"))
