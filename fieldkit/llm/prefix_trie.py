"""The trie of conversation prefixes, its subtree totals by time-forward processing.

Turns become digests, sorted by conversation and turn in range partitions, so
that a long conversation may span tasks. A prefix is named by a polynomial of
its digests modulo a prime of 127 bits; such names of parts can be put together, so
a task's prefixes are completed by what the tasks before it hold of the same
conversation (one row per task), and a conversation that begins with turns of another by that one's.
Nodes are grouped prefixes, combined before the shuffle.

Totals go from the deepest level up. A shard is sorted by reverse level order
and streamed: every node takes the messages addressed to it from a priority queue, that
spills to disk beyond a bound, and sends its own totals to its parent.
Shards are the largest subtrees under a bound on the turns below a node; the
nodes above them (for each depth as many at most as the bound fits into all turns) are processed in
bands of levels, from the deepest band to the root, each cut into shards by the
nodes of its top level. Between rounds the totals of the shards' roots are summed
by parent. So neither a first turn that a third of all conversations share nor
a very long conversation ends in one task.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import save, text_bytes, word_counts

GROUP = 20             # conversations whose first turns may come from the first of them
HEADS = 4              # fewer turns than this
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.blake2b(b"conversation prefixes", digest_size=15).digest(), "big")
ROOT = bytes(16)
SHARDS = 1 << 14       # a subtree is a shard if it has at most this part of all turns ...
SHARD_TURNS = 256      # ... or this many
BAND = 128             # levels of the nodes above the shards that are processed together, at least
BANDS = 8              # and bands, at most
QUEUE = 200_000        # messages in memory
BROADCAST_NODES = 500_000
CHUNK = 1 << 15        # conversation ids per row on their way to a node's hash


def _name(n: int) -> bytes:
    return (n % PRIME).to_bytes(16, "big")


def _number(name: bytes | None) -> int:
    return int.from_bytes(name, "big") if name else 0


class SpillQueue:
    """A priority queue of tuples that keeps at most ``limit`` of them in memory.

    Beyond it the larger half goes, sorted, to an unnamed temporary file of the
    task (as a sort's spill does: nothing is left when the task ends).
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.files = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            half = len(self.heap) // 2
            self._spill(self.heap[half:])
            del self.heap[half:]   # sorted, so still a heap

    def _spill(self, items: list[tuple]) -> None:
        self.files += 1
        file = tempfile.TemporaryFile()
        for k in range(0, len(items), 1000):
            pickle.dump(items[k:k + 1000], file)
        file.seek(0)
        self._refill(file, self.files)

    def _refill(self, file, mark: int) -> None:
        """The next items of a run, if there are any; ``mark`` tells runs with equal items apart."""
        try:
            items = pickle.load(file)
        except EOFError:
            file.close()
            return
        heapq.heappush(self.runs, (items[0], mark, 0, items, file))

    def least(self) -> tuple | None:
        """The least item, which stays."""
        tops = [q[0] if q is self.heap else q[0][0] for q in (self.heap, self.runs) if q]
        return min(tops) if tops else None

    def pop(self) -> tuple:
        if self.runs and not (self.heap and self.heap[0] <= self.runs[0][0]):
            item, mark, at, items, file = heapq.heappop(self.runs)
            if at + 1 < len(items):
                heapq.heappush(self.runs, (items[at + 1], mark, at + 1, items, file))
            else:
                self._refill(file, mark)
            return item
        return heapq.heappop(self.heap)


def _digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, words of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [hashlib.blake2b(len(r).to_bytes(8, "big") + r + t, digest_size=16).digest()
                     for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), pa.array(found, pa.binary()), pa.array(word_counts(b.column("text")))],
                names=["conv_id", "turn", "digest", "words"])

    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    kind = rows.schema["turn"].dataType.simpleString()
    rows = text_bytes(rows.withColumn("role", F.coalesce(F.col("role").cast("binary"), F.lit(b""))), "conv_id", "turn", "role")
    return rows.mapInArrow(run, f"conv_id bigint, turn {kind}, digest binary, words bigint")


def _in_runs(turns: DataFrame) -> DataFrame:
    """Turns in order, per range partition: part, conv_id, at, the names of the turns before and up to this one, words.
    ``at`` and the names begin anew in each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, at, name, power = None, 0, 0, 1
        for b in batches:
            ats, before, upto = [], [], []
            for conv, digest in zip(b.column("conv_id").to_pylist(), b.column("digest").to_pylist(), strict=True):
                if conv != now:
                    now, at, name, power = conv, 0, 0, 1
                ats.append(at)
                before.append(_name(name))
                name = (name + int.from_bytes(digest, "big") * power) % PRIME
                power = power * BASE % PRIME
                at += 1
                upto.append(_name(name))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * b.num_rows, pa.int32()), b.column("conv_id"), pa.array(ats, pa.int64()),
                 pa.array(before, pa.binary()), pa.array(upto, pa.binary()), b.column("words")],
                names=["part", "conv_id", "at", "before", "upto", "words"])

    order = ["conv_id", "turn", "digest"]   # nulls first
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "part int, conv_id bigint, at bigint, before binary, upto binary, words bigint")


def _carried(runs: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Per part whose first conversation began in an earlier one: (conv_id, turns so far, their name)."""
    ends = runs.groupBy("part", "conv_id").agg(F.max(F.struct("at", "upto")).alias("end"))
    rows = ends.groupBy("part").agg(F.min(F.struct("conv_id", "end")).alias("first"), F.max(F.struct("conv_id", "end")).alias("last"))
    out, carry = {}, None
    for r in sorted(rows.collect(), key=lambda r: r["part"]):   # a row per range partition
        (first, (n, name)), (last, (n_last, name_last)) = r["first"], r["last"]
        n, name = n + 1, _number(name)
        if carry and carry[0] == first:
            out[r["part"]] = carry
            n, name = carry[1] + n, (carry[2] + pow(BASE, carry[1], PRIME) * name) % PRIME
        carry = (first, n, name) if last == first else (last, n_last + 1, _number(name_last))
    return out


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 0), the names of the conversation's turns before and up to this one, words."""
    runs = save(_in_runs(_digests(conversations)), "turns")
    carried = _carried(runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = {part: pow(BASE, n, PRIME) for part, (_, n, _) in carried.items()}
        for b in batches:
            cols = {c: b.column(c) for c in ("conv_id", "at", "before", "upto", "words")}
            parts = b.column("part").to_pylist()
            if not carried.keys().isdisjoint(parts):
                convs, ats, before, upto = (cols[c].to_pylist() for c in ("conv_id", "at", "before", "upto"))
                for k, part in enumerate(parts):
                    if part in carried and carried[part][0] == convs[k]:
                        _, n, name = carried[part]
                        ats[k] += n
                        before[k] = _name(name + powers[part] * _number(before[k]))
                        upto[k] = _name(name + powers[part] * _number(upto[k]))
                cols |= {"at": pa.array(ats, pa.int64()), "before": pa.array(before, pa.binary()), "upto": pa.array(upto, pa.binary())}
            yield pa.RecordBatch.from_pydict(cols)

    return runs.mapInArrow(run, "conv_id bigint, at bigint, before binary, upto binary, words bigint")


def rebuilt_paths(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv_id, depth, name, above (the parent's name), words
    of its last turn, left (turns behind it). The root is there for each conversation, with depth 0.

    Conversation c begins with the first h turns of conversation c - c % group (as many as there are),
    h = crc32(c) % heads, and goes on with its own turns but its first h. ``heads=1`` leaves all as they are.
    """
    turns = ordered_turns(conversations)
    most = range(1, heads)
    first = turns.groupBy("conv_id").agg(
        F.count("*").alias("n"),
        *[F.max(F.when(F.col("at") == k - 1, F.col("upto"))).alias(f"name{k}") for k in most],
        *[F.max(F.when(F.col("at") == k - 1, F.col("words"))).alias(f"words{k}") for k in most])
    first = save(first, "conversations")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = first.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"),
                       *[F.col(f"name{k}").alias(f"own{k}") for k in most])
    base = first.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *[f"name{k}" for k in most], *[f"words{k}" for k in most])
    m = F.least("h", F.coalesce("base_n", F.lit(0)))

    def pick(name: str, k):
        return F.coalesce(*[F.when(k == i, F.col(f"{name}{i}")) for i in most], F.lit(None).cast("binary"))

    made = (own.join(base, "base", "left").withColumn("m", m)
            .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
            .withColumn("cut", pick("own", F.col("h"))).withColumn("head", pick("name", F.col("m"))))
    made = save(made.select("conv_id", "h", "m", "length", "cut", "head", *[f"{c}{k}" for c in ("name", "words") for k in most]), "rebuilt")

    roots = made.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("above"),
                        F.lit(0).cast("bigint").alias("words"), F.col("length").alias("left"))
    paths = roots
    for k in most:
        paths = paths.union(made.where(F.col("m") >= k).select(
            "conv_id", F.lit(k).cast("bigint"), f"name{k}", F.col(f"name{k - 1}") if k > 1 else F.lit(ROOT), f"words{k}", F.col("length") - k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = [pow(BASE, -k, PRIME) for k in range(heads)]
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("before", "upto", "cut", "head", "shift")]
            name, above = [], []
            for before, upto, cut, head, shift in zip(*cols, strict=True):
                cut, head = _number(cut), _number(head)
                above.append(_name(head + back[shift] * (_number(before) - cut)))
                name.append(_name(head + back[shift] * (_number(upto) - cut)))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("depth"), pa.array(name, pa.binary()), pa.array(above, pa.binary()), b.column("words"), b.column("left")],
                names=["conv_id", "depth", "name", "above", "words", "left"])

    rest = turns.join(made.select("conv_id", "h", "m", "length", "cut", "head"), "conv_id").where("at >= h")
    depth = F.col("m") + F.col("at") - F.col("h") + 1
    rest = rest.select("conv_id", depth.alias("depth"), "before", "upto", "cut", "head", (F.col("h") - F.col("m")).alias("shift"), "words",
                       (F.col("length") - depth).alias("left"))
    return paths.union(rest.mapInArrow(run, "conv_id bigint, depth bigint, name binary, above binary, words bigint, left bigint"))


def _ends(paths: DataFrame) -> DataFrame:
    """depth, name, ends_sha256: the hash of the ids of the conversations that end at a node."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids = None, 0, []
        for b in batches:
            out = []
            for depth, name, conv in zip(*(b.column(c).to_pylist() for c in ("depth", "name", "conv_id")), strict=True):
                if (depth, name) != now or len(ids) == CHUNK:
                    if ids:
                        out.append((*now, first, ",".join(map(str, ids))))
                    now, first, ids = (depth, name), conv, []
                ids.append(conv)
            yield _batch(out, "depth", "name", "first", "ids")
        if ids:
            yield _batch([(*now, first, ",".join(map(str, ids)))], "depth", "name", "first", "ids")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for b in batches:
            out = []
            for depth, name, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "name", "ids")), strict=True):
                if (depth, name) != now:
                    if sha:
                        out.append((*now, sha.hexdigest()))
                    now, sha = (depth, name), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield _batch(out, "depth", "name", "ends_sha256")
        if sha:
            yield _batch([(*now, sha.hexdigest())], "depth", "name", "ends_sha256")

    ends = paths.where("left = 0").select("depth", "name", "conv_id")
    ends = ends.repartitionByRange("depth", "name", "conv_id").sortWithinPartitions("depth", "name", "conv_id")
    parts = ends.mapInArrow(chunks, "depth bigint, name binary, first bigint, ids string")
    parts = parts.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return parts.mapInArrow(sums, "depth bigint, name binary, ends_sha256 string")


_TYPES = {"depth": pa.int64(), "name": pa.binary(), "first": pa.int64(), "ids": pa.string(), "ends_sha256": pa.string()}


def _batch(rows: list[tuple], *names: str) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[n]) for n, c in zip(names, cols, strict=True)], names=list(names))


NODE = "shard binary, top bigint, depth bigint, name binary, above binary, conv_id bigint, n_convs bigint, words bigint"


def _sharded(paths: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """Nodes with shard (the name of its root), top (its depth) and round; and the number of rounds."""
    total, n = nodes.agg(F.max("weight"), F.count("*")).first()
    limit = max(SHARD_TURNS, (total or 0) // SHARDS)
    heavy = save(nodes.where(F.col("weight") > limit), "upper_nodes")
    n_heavy, deepest = heavy.agg(F.count("*"), F.max("depth")).first()
    if not n_heavy:   # the whole trie is a shard
        return nodes.withColumns({"shard": F.lit(ROOT), "top": F.lit(0).cast("bigint"), "round": F.lit(0)}), 1
    marks = heavy.where("depth > 0").select("depth", "name")
    marks = F.broadcast(marks) if n_heavy <= BROADCAST_NODES else marks
    lowest = paths.join(marks, ["depth", "name"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("low"))
    steps = paths.select("conv_id", F.col("depth").alias("top"), F.col("name").alias("shard"))
    tops = (steps.where("top > 0").join(lowest, "conv_id", "left").where(F.col("top") == F.coalesce("low", F.lit(0)) + 1)
            .select("conv_id", "top", "shard"))
    light = nodes.where(F.col("weight") <= limit).join(tops, "conv_id").withColumn("round", F.lit(0))
    wide = max(BAND, -(-deepest // BANDS))
    bands = -(-deepest // wide)
    band = F.floor((F.col("depth") - 1) / wide)   # -1: the root
    upper = heavy.withColumns({"top": F.when(F.col("depth") == 0, F.lit(0)).otherwise(band * wide + 1).cast("bigint"),
                               "round": (bands - band).cast("int")})
    upper = upper.join(steps, ["conv_id", "top"])
    columns = [*nodes.columns, "shard", "top", "round"]
    return light.select(columns).union(upper.select(columns)), bands + 2


def _upward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard after another in reverse level order: nodes with their subtree totals."""
    shard, queue = None, SpillQueue()
    for b in batches:
        children, leaves, saved = [], [], []
        for r in zip(*(b.column(c).to_pylist() for c in ("shard", "top", "depth", "name", "above", "n_convs", "words",
                                                         "in_children", "in_leaves", "in_saved")), strict=True):
            root, top, depth, name, above, n_convs, words, n_children, n_leaves, tokens = r
            if root != shard:
                shard, queue = root, SpillQueue()
            tokens += (n_convs - 1) * words
            while (sent := queue.least()) is not None and sent[:2] == (-depth, name):
                queue.pop()
                n_children += 1
                n_leaves += sent[2]
                tokens += sent[3]
            n_leaves = n_leaves or 1
            if depth > top:
                queue.push((1 - depth, above, n_leaves, tokens))
            children.append(n_children)
            leaves.append(n_leaves)
            saved.append(tokens)
        keep = ["top", "depth", "name", "above", "conv_id", "n_convs"]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *[pa.array(c, pa.int64()) for c in (children, leaves, saved)]],
                                         names=[*keep, "n_children", "n_leaves", "saved_tokens"])


def subtree_totals(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """depth, name, above, conv_id, n_convs, n_children, n_leaves, saved_tokens of every node."""
    placed, rounds = _sharded(paths, nodes)
    placed = save(placed.select("round", "shard", "top", "depth", "name", "above", "conv_id", "n_convs", "words"), "shards")
    out = None
    for k in range(rounds):
        now = placed.where(F.col("round") == k).drop("round")
        if out is None:
            now = now.withColumns({c: F.lit(0).cast("bigint") for c in ("in_children", "in_leaves", "in_saved")})
        else:   # what roots of shards processed so far send to these nodes
            sent = out.where(F.col("depth") == F.col("top")).groupBy((F.col("depth") - 1).alias("depth"), F.col("above").alias("name")).agg(
                F.count("*").alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved"))
            now = now.join(sent, ["depth", "name"], "left").fillna(0, ["in_children", "in_leaves", "in_saved"])
        now = now.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "name").mapInArrow(
            _upward, "top bigint, depth bigint, name binary, above binary, conv_id bigint, n_convs bigint, n_children bigint, "
            "n_leaves bigint, saved_tokens bigint")
        now = save(now, f"totals_{k}")
        out = now if out is None else out.union(now)
    return out.drop("top")


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie over ``paths`` (see ``rebuilt_paths``), one row each.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. No paths: no rows, not even a root.
    """
    paths = save(paths, "paths")
    nodes = save(paths.groupBy("depth", "name").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("above").alias("above"), F.max("words").alias("words"),
        F.sum("left").alias("weight")), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    totals = subtree_totals(paths, nodes).join(parents, ["depth", "above"], "left").join(_ends(paths), ["depth", "name"], "left")
    return totals.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """``trie`` of the rebuilt ``conversations(conv_id, turn, role, text, ...)``.

    Turns go by ``turn``, nulls first, rows with the same turn by a digest of
    role and text; each row is a turn, repeated ones too. Null role or text:
    empty. Rows without a conv_id belong to no conversation. ``%`` of a
    negative conv_id has its sign. An empty table gives no rows; other columns are ignored.
    """
    return trie(rebuilt_paths(conversations, group, heads))
