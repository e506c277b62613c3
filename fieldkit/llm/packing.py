"""Best-fit packing of tokenised documents into fixed sequences.

Lengths are small integers, so the plan is made over the counts of each
length (at most ``capacity`` numbers): from the longest down, the rest of a
sequence is looked up as a single length, the sum of a pair or of three, and
as many sequences as the counts allow are made of that combination at once;
what has no exact complement is placed best-fit, by counts too. The size of
the plan depends on the number of lengths, not of documents. Pieces are then
numbered within their length by Spark and look up their place.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldkit.llm.common import save, text_bytes, tidied, worker_cache

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
BLOCK = 8 << 20         # bytes of text whose words are looked up together, about
PLACED = 1 << 18        # words of it whose ids are put in place together, about


# ASCII punctuation that is split off letters: all but the apostrophe, which may begin a contraction
AROUND = """!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"""


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]`` one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if ends.size else 0)]


class Ids:
    """Token ids of texts, each distinct word looked up once per block of texts.

    The tokenizer drops white space, splits there before merging and folds
    case, so the ids of a text are those of its words one after another. A
    block's words are numbered by Arrow; punctuation around letters is split off, as the
    tokenizer does, so that what remains to be encoded are distinct stems and a few
    marks; ids are put together again by numpy.
    """

    def __init__(self, path: str, limit: int = BLOCK):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # words of a-z need neither normalising nor splitting: the merges alone give their ids
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.limit = limit
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number per word) of words one by one."""
        ids, sizes = [np.zeros(0, np.uint32)], []
        for k in range(0, len(words), 4_000):   # an encoding holds far more than its ids
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words[k:k + 4_000], add_special_tokens=False)]
            sizes += map(len, found)
            ids.append(np.array([i for own in found for i in own], np.uint32))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def _encode_letters(self, words: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters: many as one text, parted after the ids that end a word."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 2_000):
            part = words[k:k + 2_000]
            found = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            size = np.diff(np.flatnonzero(self.ends[found]), prepend=-1)
            if size.size != len(part):
                found, size = self._encode(part)
            ids.append(found)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number per word) of distinct words."""
        stems = pc.ascii_trim(words, characters=AROUND)
        n = pc.binary_length(words).to_numpy()
        before = n - pc.binary_length(pc.ascii_ltrim(words, characters=AROUND)).to_numpy()
        letters = pc.and_(pc.ascii_is_alpha(stems), pc.ascii_is_lower(stems)).to_numpy(zero_copy_only=False)
        wide = np.zeros(len(words), bool)
        rest = np.flatnonzero(~letters)
        special = pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
        for k, stem in zip(rest.tolist(), stems.take(pa.array(rest)).to_pylist(), strict=True):
            # letters of any script, those of ASCII folded already
            wide[k] = stem.isalpha() and not special[k] and stem.encode().lower() == stem.encode()
        letters &= ~special
        split = letters | wide
        # what is encoded: distinct stems, distinct marks around them, and whole words of other kinds
        kinds = [pc.unique(stems.filter(pa.array(letters))), pc.unique(stems.filter(pa.array(wide)))]
        marked = np.flatnonzero(split & (pc.binary_length(stems).to_numpy() < n))
        around = [(w[:b], w[len(w) - a:]) for w, b, a in zip(
            words.take(pa.array(marked)).to_pylist(), before[marked].tolist(),
            (n - before - pc.binary_length(stems).to_numpy())[marked].tolist(), strict=True)]
        marks = {"": 0}
        for pair in around:
            for m in pair:
                marks.setdefault(m, len(marks))
        others = words.filter(pa.array(~split))
        parts = [self._encode(list(marks)), self._encode_letters(kinds[0].to_pylist(), self.plain),
                 self._encode_letters(kinds[1].to_pylist(), self.tokenizer), self._encode(others.to_pylist())]
        flat, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        first = np.cumsum([0, *[len(p[1]) for p in parts]])
        # three entries per word: the mark before, the stem or whole word, the mark after
        entry = np.zeros((len(words), 3), np.int64)
        entry[marked] = np.array([(marks[b], 0, marks[a]) for b, a in around], np.int64).reshape(-1, 3)
        for which, known, at in ((letters, kinds[0], first[1]), (wide, kinds[1], first[2])):
            entry[which, 1] = at + pc.index_in(stems.filter(pa.array(which)), known).to_numpy().astype(np.int64)
        entry[~split, 1] = first[3] + np.arange(len(others))
        of_entry = sizes[entry]
        return gather(flat, (np.cumsum(sizes) - sizes)[entry.ravel()], of_entry.ravel()), of_entry.sum(axis=1)

    def of_block(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, where each text's begin, and their end) of an array of strings without nulls, some texts at a time: a
        word is 4 bytes until then, and several times that where its ids are put in place."""
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(texts)
        del texts
        words = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
        begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        numbered = words.dictionary_encode()
        del lists, words
        ids, sizes = self._word_ids(numbered.dictionary)   # the empty word, at the ends of a text, has none
        starts, word = np.cumsum(sizes) - sizes, numbered.indices.to_numpy()
        del numbered
        cuts = np.flatnonzero(np.diff(begin[:-1] // PLACED)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), begin.size - 1], strict=True):
            at = word[begin[a]:begin[z]]
            of_word = sizes[at]
            upto = np.concatenate([[0], np.cumsum(of_word)])
            yield gather(ids, starts[at], of_word), upto[begin[a:z + 1] - begin[a]]

    def of(self, texts: list[bytes] | pa.Array) -> Iterator[bytes]:
        """The ids of each text as unsigned 32-bit integers, little-endian."""
        texts = pa.array(texts, pa.binary()) if isinstance(texts, list) else texts
        size = pc.binary_length(texts).to_numpy().astype(np.int64)
        block = (np.cumsum(size) - size) // self.limit   # some bytes more where a text is longer
        for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(block)) + 1):
            if rows.size:
                for ids, at in self.of_block(texts.slice(rows[0], rows.size).cast(pa.string())):
                    raw = ids.astype("<u4", copy=False).tobytes()
                    yield from (raw[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, part and nth (its number among the part's of that length)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = tokenizer_path(path)
        known = worker_cache("token ids")
        if where not in known:
            known[where] = Ids(where)
        ids = known[where]
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            row, piece, start, length, crc, nth, own = [], [], [], [], [], [], []
            for k, found in enumerate(ids.of(b.column("text"))):
                found += end
                for p, at in enumerate(range(0, len(found), 4 * capacity)):
                    cut = found[at:at + 4 * capacity]
                    n = len(cut) // 4
                    row.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(cut))
                    nth.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        own.append(cut)
            cols = [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array([part] * len(row), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(own, pa.binary())] * with_ids, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return text_bytes(docs, "doc_id").mapInArrow(
        tidied(run), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
        + ", ids binary" * with_ids)


def complements(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, how many sequences) that fill ``capacity`` exactly; ``counts`` is used up accordingly."""
    made = []

    def use(lengths: tuple[int, ...]) -> None:
        each = {n: lengths.count(n) for n in lengths}
        times = min(int(counts[n]) // k for n, k in each.items())
        made.append((lengths, times))
        for n, k in each.items():
            counts[n] -= k * times

    def pair(total: int, most: int, held: tuple[int, ...]) -> tuple[int, int] | None:
        """The pair of that sum with the longest larger length, allowing for lengths already ``held``."""
        a = np.arange(min(total - 1, most), (total - 1) // 2, -1)
        if not a.size:
            return None
        b = total - a
        free = counts.copy()
        for n in held:
            free[n] -= 1
        ok = (free[a] > 0) & (free[b] > 0) & ((a != b) | (free[a] > 1))
        at = int(np.argmax(ok))
        return (int(a[at]), int(b[at])) if ok[at] else None

    for first in range(capacity, 0, -1):
        while counts[first] > 0:
            gap = capacity - first
            if gap == 0:
                use((first,))
                continue
            if gap <= first and counts[gap] > (gap == first):
                use((first, gap))
                continue
            two = pair(gap, first, (first,))
            if two:
                use((first, *two))
                continue
            found = None
            lengths = np.flatnonzero(counts[:min(first, gap - 2) + 1])[::-1]
            for second in lengths.tolist():
                if second == 0 or 3 * second < gap:
                    break
                if second == first and counts[first] < 2:
                    continue
                two = pair(gap - second, second, (first, second))
                if two:
                    found = (first, second, *two)
                    break
            if not found:
                break
            use(found)
    return made


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, how many sequences): from the longest down, each piece into the fullest sequence that takes it."""
    by_gap: dict[int, list[list]] = {}   # gap -> [lengths, times]
    gaps: list[int] = []                 # sorted gaps in use

    def put(gap: int, lengths: tuple[int, ...], times: int) -> None:
        if not times:
            return
        if gap not in by_gap:
            by_gap[gap] = []
            insort(gaps, gap)
        by_gap[gap].append([lengths, times])

    for n in range(capacity, 0, -1):
        left = int(counts[n])
        while left:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                fits = capacity // n
                put(capacity - fits * n, (n,) * fits, left // fits)
                if left % fits:
                    put(capacity - (left % fits) * n, (n,) * (left % fits), 1)
                break
            gap = gaps[at]
            group = by_gap[gap][-1]
            fits = gap // n
            if left >= fits * group[1]:
                by_gap[gap].pop()
                put(gap - fits * n, group[0] + (n,) * fits, group[1])
                left -= fits * group[1]
            else:
                whole, rest = divmod(left, fits)
                group[1] -= whole + (rest > 0)
                put(gap - fits * n, group[0] + (n,) * fits, whole)
                if rest:
                    put(gap - rest * n, group[0] + (n,) * rest, 1)
                if not group[1]:
                    by_gap[gap].remove(group)
                left = 0
            if not by_gap[gap]:
                del by_gap[gap]
                gaps.remove(gap)
    return [(tuple(lengths), times) for groups in by_gap.values() for lengths, times in groups]


def make_plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact complements first, best fit for the rest."""
    rest = counts.copy()
    return complements(rest, capacity) + best_fit(rest, capacity)


def places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of piece numbers, as sorted keys (length, first number), with the first sequence and the offset of each."""
    used = np.zeros(capacity + 1, np.int64)
    keys, first, offset, sequence = [], [], [], 0
    for lengths, times in plan:
        at = 0
        for n in lengths:
            keys.append((n << 44) + int(used[n]))
            first.append(sequence)
            offset.append(at)
            used[n] += times
            at += n
        sequence += times
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return (np.array(keys, np.int64)[order], np.array(first, np.int64)[order], np.array(offset, np.int64)[order])


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece of ``docs(doc_id, text, ...)``: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are one piece of the end id; rows with a null or
    repeated doc_id are packed like any other; an empty table gives no rows;
    other columns are ignored. ``path``: the tokenizer's file on the executors.
    """
    cut = save(pieces(docs, capacity, path, with_ids), "pieces")
    sizes = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # capacity rows at most
        counts[r["length"]] = r["n"]
    keys, first, offset = places(make_plan(counts, capacity), capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    numbered = cut.join(ahead, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("ahead"))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = (b.column("length").to_numpy() << 44) + b.column("nth").to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in cols], pa.array(first[at] + key - keys[at]), pa.array(offset[at])],
                names=[*cols, "sequence_id", "offset"])

    wide = numbered.select(*cols, "nth")
    schema = wide.drop("nth").schema.add("sequence_id", LongType()).add("offset", LongType())
    return wide.mapInArrow(run, schema)
