"""Plain forms of the contracts, one document after the other."""

import collections
import hashlib
import re
import zlib

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def components(texts):
    """Component of each row, by all pairs that share a shingle."""
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    pairs = {(a, b) for rows in holders.values() for i, a in enumerate(rows) for b in rows[:i]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(texts):
        if doc is not None:
            least[root(k)] = min(doc, least.get(root(k), doc))
    return [(doc, len(sets[k]), least.get(root(k))) for k, (doc, _) in enumerate(texts)]


def base_spans(text):
    text = text or ""
    kinds = {
        "assign": [m for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6],
        "access": [m for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        "hex": [m for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24],
    }
    spans = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, ms) in enumerate(kinds.items()) for m in ms)
    digest = hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
    return [len(kinds[k]) for k in ("assign", "access", "hex")] + [digest]


def remainder(doc, modulus):
    return zlib.crc32(str(doc).encode() if doc is not None else b"") % modulus
