"""Plain Python versions of the training-data operators, for small tables."""
import math
import re
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import duckdb
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(sf_dir, table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()


def groups_of(nodes, linked):
    """{node: least node reachable} for linked(a, b) over all pairs."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def simhash(text, k=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near_groups(docs, radius=2):
    """{doc_id: (fingerprint, component)} of (doc_id, text) pairs with unique ids."""
    fp = {i: simhash(t) for i, t in docs}
    comp = groups_of(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= radius)
    return {i: (f"{fp[i]:016x}", comp[i]) for i in fp}


def exact_groups(docs):
    """{doc_id: (keep_id, size, sha256)} of (doc_id, text) pairs with unique ids."""
    by = defaultdict(list)
    for i, t in docs:
        by[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), sha256(k.encode()).hexdigest()) for k, g in by.items() for _, i in g}


def substring(docs, window=50):
    """{doc_id: (n_words, n_removed, sha256 of the kept words)} of (doc_id, text) pairs."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i, w in sorted(words.items()):
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p:p + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), sha256(kept.encode()).hexdigest())
    return out


def fill_middle(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    h = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, m, z = text[:p], text[p:q], text[q:]
    if h4 % 100 < 20:
        return n, "spm", p, q - p, f"<S>{z}<P>{a}<M>{m}"
    return n, "psm", p, q - p, f"<P>{a}<S>{z}<M>{m}"


def prefix_trie(convs):
    """{prefix of turns: (conv_id, depth, parent conv_id, members, children, leaves, saved, digest)}
    of {conv_id: [(role, text), ...]}; a conv_id of None is after every other."""
    def least(ids):
        return min(ids, key=lambda i: (i is None, i or 0))
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    out = {}
    for p, m in members.items():
        ids = sorted(ends[p], key=lambda i: (i is None, i or 0))
        digest = sha256(",".join("" if i is None else str(i) for i in ids).encode()).hexdigest()
        out[p] = (least(m), len(p), least(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p],
                  saved[p], digest)
    return out


def rebuilt(convs):
    """{conv_id: turns} with heads exchanged, from {conv_id: turns}."""
    out = {}
    for c, turns in convs.items():
        h = 0 if c is None else crc32(str(c).encode()) % 4
        base = [] if c is None else convs.get(c - int(math.fmod(c, 20)), [])
        out[c] = base[:h] + turns[h:]
    return out


def shingles(text, k=2):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def minhash_groups(docs, percent=80):
    """{doc_id: (n_shingles, component)} of (doc_id, text) pairs with unique ids."""
    sets = {i: shingles(t) for i, t in docs}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return bool(sets[a] and sets[b]) and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
    comp = groups_of(list(sets), linked)
    return {i: (len(sets[i]), comp[i]) for i in sets}
