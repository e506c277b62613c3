"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    bits = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(parts))


def removed_lines(docs, least):
    """Lines to delete per document of [(doc_id, text)], in doc_id order."""
    seen, out = set(), {}
    for doc_id, text in docs:
        lines = text.split("\n")
        n = [len(WORD.findall(x)) for x in lines]
        runs = set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(n[i:j]) >= least:
                    runs.add((i, j))
                    break
        for j in range(1, len(lines) + 1):
            for i in range(j - 1, -1, -1):
                if sum(n[i:j]) >= least:
                    runs.add((i, j))
                    break
        gone = set()
        for i, j in sorted(runs):
            key = tuple(lines[i:j])
            if key in seen:
                gone.update(range(i, j))
            seen.add(key)
        out[doc_id] = gone
    return out


def maximal_run_lines(docs, least):
    """The same lines straight from the definition: every run of ``least`` words that came before."""
    places, out = [], {}
    for doc_id, text in docs:
        lines = text.split("\n")
        for i in range(len(lines)):
            places.append((doc_id, i, lines))
    for at, (doc_id, i, lines) in enumerate(places):
        gone = out.setdefault(doc_id, set())
        for _, k, other in places[:at]:
            run = 0
            while i + run < len(lines) and k + run < len(other) and lines[i + run] == other[k + run]:
                run += 1
            if sum(len(WORD.findall(x)) for x in lines[i:i + run]) >= least:
                gone.update(range(i, i + run))
    return out


def quality_figures(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeat = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            repeat.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(repeat))


def base_spans(text):
    found = []
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    for m in assign.finditer(text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, m.end(), "hex"))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def cosine_links(vectors, least):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    return near


def vector_codes(vectors, parts, entries, rounds):
    """(codes, errors, codebooks) of integer vectors in id order, by comparing everything with everything."""
    x = np.array(vectors, np.int64).reshape(len(vectors), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[code[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    code, error = nearest()
    return code, error.sum(1), books


def conversation_trie(rows, group=20, heads=4):
    """Nodes of the trie of rebuilt conversations, of rows (conv_id, turn, role, text) without two of one turn."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(s)] for c, s in turns.items()}
    rebuilt = {}
    for c, s in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, group)), [])[:h] + s[h:])
    members, children = {}, {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for s in members:
        if s:
            children.setdefault(s[:-1], []).append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        below = children.get(s, [])
        leaves[s] = sum(leaves[k] for k in below) or 1
        words = len(WORD.findall(s[-1][1])) if s else 0
        saved[s] = (len(members[s]) - 1) * words + sum(saved[k] for k in below)
        ends = ",".join(str(c) for c in sorted(members[s]) if len(rebuilt[c]) == len(s))
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(below), leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])
