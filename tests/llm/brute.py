"""Plain-Python answers for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def shingles(text):
    w = words(low(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near_duplicates(docs):
    """{id: component} of (id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def repeats(texts, size=35):
    """(n_words, n_removed, sha256 of what is kept) for each text."""
    ws = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in ws for i in range(len(w) - size + 1))
    out = []
    for w in ws:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone |= set(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contamination(texts, items, size=13):
    windows = defaultdict(set)
    for item, t in items:
        w = bench_words(t)
        for i in range(max(1, len(w) - size + 1)):
            if w:
                windows[tuple(w[i:i + size])].add("null" if item is None else str(item))
    out = []
    for t in texts:
        w = bench_words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= owners
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


SECRETS = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
               lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def secrets(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, (rx, ok)) in enumerate(SECRETS.items())
             for m in rx.finditer(text or "") if ok(m)]
    return ",".join(f"{kind}:{a}:{z}" for a, _, kind, z in sorted(found))


def token_rows(docs, tokenizer, end_id=2):
    out, start = [], 0
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out
