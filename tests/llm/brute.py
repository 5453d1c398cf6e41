"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower_words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in BLANKS:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def bpe(docs: dict, ranks: dict[bytes, int], pattern: str) -> dict:
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = {}
    for d, t in docs.items():
        ids = own.encode_ordinary(t or "")
        out[d] = (len(ids), sha(" ".join(map(str, ids))), sha(own.decode_bytes(ids)))
    return out


def line_dedup(docs: dict, at_least: int = 3, shortest: int = 20) -> dict:
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    split = {d: (t or "").split("\n") for d, t in docs.items()}
    held = defaultdict(set)
    for d, lines in split.items():
        for line in lines:
            held[key(line)].add(d)
    gone = lambda d, line: len(key(line)) >= shortest and len(held[key(line)]) >= at_least and max(held[key(line)]) != d
    out = {}
    for d, lines in split.items():
        kept = [x for x in lines if not gone(d, x)]
        out[d] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def components(nodes: list, links: list[tuple]) -> dict:
    label = {n: n for n in nodes}
    find = lambda n: n if label[n] == n else find(label[n])
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return {n: find(n) for n in nodes}


def simhash(docs: dict, radius: int = 3) -> dict:
    prints = {}
    for d, t in docs.items():
        w = lower_words(t)
        shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= radius]
    groups = components(ids, links)
    return {d: (f"{prints[d]:016x}", groups[d]) for d in ids}


def near_vectors(rows: list[tuple], cosine: float = 0.93) -> dict:
    """rows: (id, vector or None, label or None); ids differ."""
    ok = {}
    for i, v, label in rows:
        v = None if v is None or any(x is None for x in v) else np.array(v, dtype=np.float64)
        if v is not None and label is not None and len(v) and np.isfinite(v).all() and v.any():
            ok[i] = (v / np.sqrt(v @ v), label)
    ids = sorted(ok)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[:i]
        if ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= cosine
    ]
    n = Counter(x for link in links for x in link)
    groups = components([r[0] for r in rows], links)
    return {i: (n[i], groups[i], groups[i] == i) for i, _, _ in rows}


def suffix_dedup(docs: dict, length: int = 200) -> dict:
    """docs: id to text, or to a list of texts for rows that repeat an id."""
    raw = {d: (t or "").encode() for d, t in docs.items()}
    places = defaultdict(list)
    for d, b in raw.items():
        for i in range(len(b) - length + 1):
            places[b[i : i + length]].append((d, i))
    gone = {d: bytearray(len(b)) for d, b in raw.items()}
    for where in places.values():
        if len(where) > 1:
            for d, i in where:
                gone[d][i : i + length] = b"\1" * length
    out = {}
    for d, b in raw.items():
        marks = bytes(gone[d])
        spans = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        out[d] = (len(b), sum(marks), spans, sha(bytes(x for x, m in zip(b, marks, strict=True) if not m)))
    return out


def packed_ids(docs: dict, tokenizer_file: str) -> dict:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file)
    return {d: [*t.encode(x or "", add_special_tokens=False).ids, 1] for d, x in docs.items()}


def check_packing(pieces, ids: dict, length: int = 2048) -> None:
    """pieces: dict rows of the digest; every id is in one piece, sequences have no gaps."""
    at = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        mine = ids[p["doc_id"]]
        assert p["start"] == at[p["doc_id"]] and p["length"] > 0 and p["doc_tokens"] == len(mine)
        part = mine[p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] and p["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        at[p["doc_id"]] += p["length"]
    assert dict(at) == {d: len(x) for d, x in ids.items()}
    fill = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == fill[p["sequence_id"]]
        fill[p["sequence_id"]] += p["length"]
    assert all(n <= length and (n == length or n & (n - 1) == 0) for n in fill.values()), json.dumps(fill)


def quality(text: str | None) -> tuple:
    text = text or ""
    w, word = [], ""
    for c in text + " ":
        if c in BLANKS:
            w += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) for j in range(3) if windows[tuple(w[i : i + 3])] > 1}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += line in seen
            seen.add(line)
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, r, n < 50 or 100 * r > 50 * n


def words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def runs(w: list) -> list[tuple]:
    """(start, length, period) of every run, by trying all periods at all places."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic_runs(docs: dict) -> dict:
    out = {}
    for d, t in docs.items():
        w = words(t)
        h = zlib.crc32(str("" if d is None else d).encode())
        if h % 10 == 0 and w:
            g, n, first = h // 10, len(w), list(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [first[i] if i < a else first[a + (i - a) % p] for i in range(n)]
        r = runs(w)
        best = min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None,) * 3
        gone = {i for s, n, q in r for i in range(s + q, s + n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        milli = 1000 * best[1] // best[2] if r else None
        out[d] = (len(r), *best, milli, sha("".join("%d,%d,%d\n" % x for x in r)), sha(kept))
    return out


def prefix_trie(rows: list[tuple]) -> list[tuple]:
    """rows: (conv_id, turn, role, text); equal turns of a conversation are equal rows."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(told.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(words(p[-1][1])) if p else 0
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
            sha(",".join(map(str, sorted(ends[p])))),
        )
        for p, m in members.items()
    )
