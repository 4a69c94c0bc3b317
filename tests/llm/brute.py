"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width=5):
    words = split(text)
    if 0 < len(words) < width:
        return Counter([tuple(words)])
    return Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def near_classes(rows, similarity=0.8):
    """{id: least id of its class} by comparing all texts that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    texts = {i: t or "" for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(a, b):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)

    having, equal = defaultdict(list), {}
    for i, s in sets.items():
        link(i, equal.setdefault(texts[i], i))
        for k in s:
            having[k].append(i)
    for ids in having.values():
        for a in ids:
            for b in ids:
                if a < b and top(a) != top(b):
                    both = sum((sets[a] & sets[b]).values())
                    if both >= similarity * sum((sets[a] | sets[b]).values()):
                        link(a, b)
    return {i: top(i) for i in sets}


def benchmark_hits(docs, items, window=13):
    """{id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    of = defaultdict(set)
    for i, t in items:
        w = words(t)
        width = min(window, len(w))
        for k in range(len(w) - width + 1 if w else 0):
            of[tuple(w[k : k + width])].add(i)
    widths = {len(k) for k in of}
    out = {}
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in widths:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in of:
                    hit.update(range(k, k + n))
                    found |= of[key]
        ids = sorted(str(x) for x in found if x is not None)
        out[d] = (len(w), len(hit), len(ids), sha(",".join(ids)), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def without_repeats(rows, window=13):
    """[(id, n_words, n_removed, kept_sha256)]"""
    least = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def sketch(text, width=5, scale=1):
    """Hashes as Spark's xxhash64 gives them."""
    import xxhash

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def chain(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v, seed)
        return signed(seed)

    h = [chain([w.encode()]).to_bytes(8, "little", signed=True) for w in split(text)]
    if 0 < len(h) < width:
        found = {chain(h)}
    else:
        found = {chain(h[k : k + width]) for k in range(len(h) - width + 1)}
    return sorted(x for x in found if x > (1 << 63) - 1 - (1 << 64) // scale)


def fingerprints(rows, scale=1):
    """[(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)]"""

    def like(s, t):
        a, b = sketch(s, scale=scale), sketch(t, scale=scale)
        if not a and not b:
            return float(s == t or not (split(s) or split(t)))
        return len(set(a) & set(b)) / len(set(a) | set(b))

    def text(a):
        return "".join(f"{x & (2**64 - 1):016x}" for x in a)

    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0], hashlib.md5(r[1].encode()).hexdigest()), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        prints = [text(sketch(x, scale=scale)) for x in (t, edited)]
        out.append((i, len(t), sha(edited), *prints, like(t, edited), like(t, after)))
    return out


def personal(text):
    """[(kind, start, end)] by the patterns as they are stated."""

    def luhn(d):
        n = [int(c) for c in d][::-1]
        return (sum(n[::2]) + sum(sum(divmod(2 * x, 10)) for x in n[1::2])) % 10 == 0

    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x[-4000:]) <= 255 for x in m.split("."))),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 14 <= len(d := re.sub("[ -]", "", m)) <= 19 and luhn(d),
        ),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    found = []
    for k, (kind, (pattern, good)) in enumerate(checks.items()):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "") if good(m[0])]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]
