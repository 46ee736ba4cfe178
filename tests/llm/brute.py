"""Plain Python versions of the corpus operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, length):
    """{id: (n_words, n_removed, kept text)} for unique ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        words = SPACE.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            if key in seen:
                gone[i : i + length] = [True] * length
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), kept)
    return out


def contamination(rows, items, size=10):
    """{id: (n_words, n_hit, sorted items)}."""
    windows = {}
    for item, text in items:
        words = ALNUM.findall(fold(text))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = {}
    for doc, text in rows:
        words, hit, named = ALNUM.findall(fold(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                key = tuple(words[i : i + n])
                if key in windows:
                    hit.update(range(i, i + n))
                    named.update(str(x) for x in windows[key] if x is not None)
        out[doc] = (len(words), len(hit), sorted(named))
    return out


def shingles(text, size=5):
    words = SPACE.findall(fold(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components(rows):
    """{id: (n_shingles, component)} for unique ids; all pairs are compared by common shingles."""
    sets = {doc: shingles(text) for doc, text in rows}
    parent, holders = {d: d for d in sets}, {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc, own in sets.items():
        common = Counter(other for s in own for other in holders.get(s, ()))
        for other, n in common.items():
            if 100 * n >= 75 * (len(own) + len(sets[other]) - n):
                a, b = sorted((root(doc), root(other)))
                parent[b] = a
        for s in own:
            holders.setdefault(s, []).append(doc)
    return {d: (len(sets[d]), root(d)) for d in sets}


ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def secrets(text):
    """Base spans (start, kind, end)."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def crc_of_ids(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def jump(key, shards):
    key, b, j = (key or 0) % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def resampling(rows, target, percent=5, seed=42, min_words=20, buckets=10_000):
    """[(doc_id, n_features, weight, score, rank)] of all rows, ids null or not, rows repeated or not."""

    def features(text):
        w = ALNUM.findall(fold(text))
        runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
        return len(w), Counter(zlib.crc32(r.encode()) % buckets for r in runs)

    found = [(doc, *features(text)) for doc, text in rows]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
        for b in range(buckets)
    ]
    scored = []
    for doc, words, f in found:
        h = int(sha(f"{seed}:{'' if doc is None else doc}")[:8], 16)
        weight = sum(gain[b] * n for b, n in f.items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc, sum(f.values()), weight, score, words))
    able = [r for r in scored if r[4] >= min_words]
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = percent * len(able) // 100
    out = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return out + [(*r[:4], None) for r in scored if r[4] < min_words]


def merkle(rows, fanout=2):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] for (doc_id, source, lang, n_chars, text)."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(row):
        return sha("".join(map(field, row)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            n = levels[-1]
            levels.append([sha("".join(n[i : i + fanout])) for i in range(0, len(n), fanout)])
        return levels

    by_lang = {}
    for row in sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(),
                                           r[0] is not None, r[0] or 0, leaf(r))):
        by_lang.setdefault(row[2], []).append(row)
    trees = [tree([leaf(r) for r in group]) for group in by_lang.values()]
    top, out = tree([t[-1][0] for t in trees]), []
    for k, group in enumerate(by_lang.values()):
        for i, row in enumerate(group):
            steps = []
            for levels, at in ((trees[k], i), (top, k)):
                for nodes in levels[:-1]:
                    first = at - at % fanout
                    steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fanout])))
                    at //= fanout
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf((*row[:3], row[3] + 1, row[4]) if hit and row[3] is not None else row)
            for before, after in steps:
                node = sha(before + node + after)
            out.append((row[0], leaf(row), trees[k][-1][0], top[-1][0],
                        sha("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return out


def targets(sizes, weights, most=3):
    """Words of each source: shares by weight, limited, the excess reshared, round by round."""
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(most * sizes[i] for i in capped)
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        above = {i for i in free if share[i] > most * sizes[i]}
        if not above:
            return [share.get(i, most * sizes[i]) for i in range(len(sizes))]
        capped |= above
