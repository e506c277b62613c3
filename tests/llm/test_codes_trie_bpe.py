import hashlib
import heapq
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from fieldkit.llm import bpe, prefix_trie, vector_codes

from . import brute


# --- vector codes -------------------------------------------------------------------------------------------------

def embeddings(n, dim, scale, seed=0):
    rng = np.random.default_rng(seed)
    x = (rng.integers(-scale, scale + 1, (n, dim)) / 256 + rng.uniform(0, 1 / 300, (n, dim))).astype(np.float32)
    if n > 60:
        x[30:55] = x[3]                # copies
        x[:, :4] = 0.25                # a part without any difference
    return x


SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, ids string, points string, n int, part int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *["x"] * 4, 1, 2) for i, v, label in rows], SCHEMA).repartition(3)


def floats(v):
    return [float(c) for c in v]


@pytest.mark.parametrize("n, dim, scale, tree_rows", [(400, 64, 40, 90), (300, 32, 3, 4096), (200, 16, 300, 64), (20, 64, 40, 4096), (1, 16, 5, 10)])
def test_vector_codes_against_brute_force(spark, n, dim, scale, tree_rows):
    x = embeddings(n, dim, scale)
    got, books = vector_codes.compress(frame(spark, [(7 * i, floats(v), i % 3) for i, v in enumerate(x)]), tree_rows=tree_rows)
    code, error, want = brute.vector_codes(np.floor(256 * x.astype(float)), 16, 64, 2)
    assert (books == want).all()
    rows = {r["vec_id"]: r for r in got.collect()}
    assert {i: (r["code"], r["error"]) for i, r in rows.items()} == {
        7 * k: (bytes(code[k].tolist()).hex(), int(error[k])) for k in range(n)}
    assert vector_codes.digest(books) == hashlib.sha256(",".join(str(v) for v in want.ravel()).encode()).hexdigest()


def test_vectors_that_are_no_vectors(spark):
    x = embeddings(90, 16, 40)
    rows = [(i, floats(v), None if i % 4 == 0 else i % 4) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [1.0] * 15 + [None], 1), (1003, [float("nan")] * 16, 1),
           (1004, [float("inf")] + [0.0] * 15, 1), (1005, [0.5] * 32, 9), (1006, [0.5] * 7, None)]
    more = [(None, floats(x[5]), 2), (None, floats(x[6]), 2), (3, floats(x[3]), 3), (3, floats(x[3]), 3)]
    made, books = vector_codes.compress(frame(spark, rows + odd + more), tree_rows=32)
    got = vector_codes.with_label_errors(made).collect()
    # null ids come last, equal ids in the order of their vectors
    ordered = sorted(rows + more, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    code, error, want = brute.vector_codes(np.floor(256 * np.array([r[1] for r in ordered])), 16, 64, 2)
    assert (books == want).all()
    by_label = {}
    for (_, _, label), e in zip(ordered, error, strict=True):
        by_label[label] = by_label.get(label, 0) + int(e)
    expected = [(r[0], bytes(c.tolist()).hex(), int(e), by_label[r[2]]) for r, c, e in zip(ordered, code, error, strict=True)]
    expected += [(1001, None, None, by_label[1]), (1005, None, None, None), (1006, None, None, by_label[None])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1)]):
        made, books = vector_codes.compress(frame(spark, rows) if rows else spark.createDataFrame([], SCHEMA))
        assert vector_codes.with_label_errors(made).collect() == [] and books.size == 0
        assert vector_codes.digest(books) == hashlib.sha256().hexdigest()


def test_huge_components_are_taken_as_the_limit(spark):
    made, books = vector_codes.compress(frame(spark, [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, 1)]))
    assert {r["vec_id"]: (r["code"], r["error"]) for r in made.collect()} == {1: ("00" * 16, 0), 2: ("01" * 16, 0), 3: ("02" * 16, 0)}
    assert books.max() == vector_codes.LIMIT


def test_cover_trees():
    x = np.random.default_rng(4).integers(-60, 60, (700, 16, 3))
    x[:, 0] = x[:, 0] // 20
    t = vector_codes.build(x)
    sizes = t.end - t.first
    assert sizes[:16].tolist() == [700] * 16
    for k in range(len(t.first)):
        own = t.points[t.first[k]:t.end[k]]
        assert t.first[k] <= t.middle[k] < t.end[k]
        assert t.radius[k] == ((own - t.points[t.middle[k]]) ** 2).sum(1).max()
        kids = range(t.child[k], t.child[k] + t.children[k])
        if kids:   # side by side, together the node; centres farther apart than they reach
            assert t.first[kids[0]] == t.first[k] and t.end[kids[-1]] == t.end[k]
            assert all(t.end[a] == t.first[a + 1] for a in kids[:-1])
            centres = t.points[t.middle[list(kids)]]
            reach = max(t.radius[list(kids)])
            apart = ((centres[:, None] - centres[None]) ** 2).sum(-1) + 10**9 * np.eye(len(kids), dtype=int)
            assert reach < t.radius[k] and (apart > reach).all()
        else:
            assert sizes[k] <= vector_codes.LEAF or t.radius[k] == 0
    for part in range(16):
        assert (t.points[np.argsort(t.rows[part * 700:(part + 1) * 700]) + part * 700] == x[:, part]).all()


def test_subtrees_are_assigned_as_a_whole():
    x = np.random.default_rng(2).integers(0, 5, (2000, 16, 2)) + 100 * np.random.default_rng(3).integers(0, 8, (2000, 16, 1))
    found = vector_codes.assign(vector_codes.build(x), x[:64].transpose(1, 0, 2))
    assert found.compared < x.shape[0] * 16 * 64 / 10


# --- conversations ------------------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, name string, shard string, left string"


def talk(spark, rows, n=3):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], TURNS).repartition(n)


def conversations(seed=0):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 90), 200, 203, 219, -3, -20, -41, 1001, 1003]:
        shared = rng.random() < 0.5     # half of all begin alike
        for t in range(rng.randint(1, 7)):
            text = f"turn {t} of many" if shared and t < 3 else " ".join(rng.choices(["a", "bb", "c\n", " "], k=rng.randint(0, 6)))
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rows += [(40 * 20, t, "user", "on and on" if t % 3 else f"no {t}") for t in range(300)]      # a long one, continued by others
    rows += [(40 * 20 + k, t, "user", f"{k} says {t}") for k in (1, 2, 3, 4, 5) for t in range(6)]
    rows += [(500, None, "user", "before all others"), (500, 0, None, None), (500, 1, "", "x"), (501, 5, "user", None)]
    rows += [(7000 + k, t, "user", "all alike") for k in range(25) for t in range(4)]
    rows += [(None, 1, "user", "in no conversation"), (9000, 0, "user", "the same words " * 2000)]
    return rows


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("limits", [{}, {"SHARD_TURNS": 8, "BAND": 5, "BANDS": 100}, {"SHARD_TURNS": 1, "BAND": 64, "BROADCAST_NODES": 0},
                                    {"SHARD_TURNS": 30, "BAND": 1, "BANDS": 3, "CHUNK": 3}, {"SHARD_TURNS": 10**9}])
def test_trie_against_brute_force(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(prefix_trie, k, v)
    rows = conversations()
    assert nodes(prefix_trie.conversation_trie(talk(spark, rows))) == brute.conversation_trie(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(1)
    assert nodes(prefix_trie.conversation_trie(talk(spark, rows), heads=1)) == brute.conversation_trie(rows, heads=1)


def test_repeated_turns_and_no_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    got = nodes(prefix_trie.conversation_trie(talk(spark, rows), heads=1))
    assert got == brute.conversation_trie(rows, heads=1) and [r[3] for r in got] == [2, 2, 1, 1]
    tied = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None)]
    one, two = (nodes(prefix_trie.conversation_trie(talk(spark, t, 1), heads=1)) for t in (tied, tied[::-1]))
    assert one == two and len(one) == 4
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.conversation_trie(talk(spark, [(None, 1, "user", "x")])).collect() == []


def test_a_conversation_over_many_tasks(spark):
    rows = [(20, t, "user", f"w{t % 5}") for t in range(500)] + [(21, t, "user", f"w{t % 5}") for t in range(400)] + [(22, 0, "user", "w0")]
    turns = prefix_trie.ordered_turns(talk(spark, rows)).collect()
    assert sorted((r["conv_id"], r["at"]) for r in turns) == sorted((c, t) for c, t, *_ in rows)
    name = {(r["conv_id"], r["at"]): bytes(r["upto"]) for r in turns}
    assert all(name[20, k] == name[21, k] for k in range(400)) and len(set(name.values())) == 500
    assert nodes(prefix_trie.conversation_trie(talk(spark, rows))) == brute.conversation_trie(rows)


def test_spilling_queue():
    rng = random.Random(5)
    queue, plain = prefix_trie.SpillQueue(limit=20), []
    for _ in range(5000):
        if plain and rng.random() < 0.45:
            assert queue.least() == plain[0]
            assert queue.pop() == heapq.heappop(plain)
        else:
            item = (rng.randint(0, 50), bytes([rng.randint(0, 3)]), rng.randint(0, 9))
            queue.push(item)
            heapq.heappush(plain, item)
    assert queue.files > 3 and len(queue.heap) <= 20
    while plain:
        assert queue.pop() == heapq.heappop(plain)
    assert queue.least() is None


# --- byte BPE -----------------------------------------------------------------------------------------------------

ALPHABET = "aeth nr'l \n\t=-é中😀12<|>S"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(*bpe.vocabulary_of(None, None))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_pairs_that_the_merges_leave_alone(vocabulary, library):
    rng = random.Random(1)
    for _ in range(300):
        a, b = rng.choices(range(256, 20_000), k=2)
        both = vocabulary.tokens[a] + vocabulary.tokens[b]
        assert vocabulary.fits(a, b) == (vocabulary.merged(both) == [a, b])
        if both not in vocabulary.ranks:
            assert vocabulary.piece_ids(both) == vocabulary.merged(both)


def test_every_prefix_has_one_valid_last_token(vocabulary):
    data = "reencodings of  naïve 中文 words======".encode()
    table = bpe.Prefixes(vocabulary, data)
    for n in range(1, len(data) + 1):
        whole = vocabulary.merged(data[:n])
        assert table.last[n - 1] == whole[-1]
        assert vocabulary.read(table.last[:n]) == whole


def test_texts_appends_and_edits(vocabulary, library):
    rng = random.Random(2)
    for _ in range(400):
        s = "".join(rng.choices(ALPHABET, k=rng.randint(0, 40)))
        text = bpe.EncodedText(vocabulary, s)
        for _ in range(5):
            assert text.ids() == library.encode_ordinary(s)
            a = rng.randint(0, len(s))
            b = rng.randint(a, min(len(s), a + 5))
            new = "".join(rng.choices(ALPHABET, k=rng.randint(0, 6)))
            if rng.random() < 0.3:
                text.append(new)
                s += new
            else:
                text.replace(a, b, new)
                s = s[:a] + new + s[b:]
            assert text.text == s
        assert text.ids() == library.encode_ordinary(s)


def test_an_edit_redoes_only_what_is_near(vocabulary):
    data = bytes(random.Random(3).choices(b"abcde", k=20_000))
    table = bpe.Prefixes(vocabulary, data)
    done = table.worked
    table.replace(9_000, 9_003, b"xyzzy")
    assert table.worked - done < 3 * vocabulary.longest
    assert table.ids() == bpe.Prefixes(vocabulary, table.data).ids()
    done = table.worked
    table.append(b"more")
    assert table.worked - done == 4 and table.ids() == vocabulary.piece_ids(table.data)


def test_blocks_split_like_the_whole(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 7)
    rng = random.Random(4)
    for _ in range(300):
        s = "".join(rng.choices(ALPHABET, k=rng.randint(0, 60)))
        assert [p for block in vocabulary.split(s) for p in block] == vocabulary.find(s)


def test_round_trip_of_documents(spark, docs, odd, none, rows, library):
    for df in (docs, odd):
        texts = {(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()}
        want = sorted((str(i), len(ids := library.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts)
        got = bpe.round_trip(df)
        assert got.count() == df.count()
        assert sorted({(str(r[0]), *r[1:]) for r in got.collect()}) == want
    assert bpe.round_trip(none).collect() == []


def test_encode_and_decode(spark, docs, rows):
    texts = {r[0]: r[1] or "" for r in rows}
    back = bpe.decode(bpe.encode(docs)).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in back} == texts
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in back)
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")).first()["decoded"] is None


def test_a_table_of_matches_that_starts_anew(vocabulary, library):
    rng = random.Random(6)
    texts = ["".join(rng.choices(ALPHABET, k=50)) for _ in range(200)]
    small = bpe.Encoder(vocabulary, limit=10)
    assert [np.frombuffer(i, np.uint32).tolist() for i in small.of(texts, 7)] == [library.encode_ordinary(t) for t in texts]


def test_a_very_long_text(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 5000)
    text = " ".join(f"word{k % 977}é" for k in range(20_000)) + "=" * 30_000
    [ids] = bpe.Encoder(vocabulary).of([text])
    assert vocabulary.decode(ids) == text.encode()
    assert np.frombuffer(ids, np.uint32).tolist()[:60_000] == library.encode_ordinary(text[:-30_000])[:60_000]
