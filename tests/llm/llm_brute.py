"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import re

import numpy as np
import xxhash

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def written(spans):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text, each=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    n = max(1, len(words) - each + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + each]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


class Forest:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def cosines(rows):
    x = np.array(rows, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def license_base(text):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hits = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    first, last = (min(hits)[0], max(hits)[0]) if hits else (None, None)
    return len(words), len(hits), first, last, ",".join(sorted({x for _, x in hits}))


def water_fill(budget, children):
    """Whole tokens per child (name, cap, weight), shortages to siblings."""
    take, todo = {}, sorted(children, key=lambda c: (c[1] / c[2], c[0]))
    left = min(budget, sum(c[1] for c in children))
    while todo:
        name, cap, weight = todo[0]
        if left * weight < cap * sum(c[2] for c in todo):
            break
        take[name] = cap
        left -= cap
        todo = todo[1:]
    heavy = sum(c[2] for c in todo)
    parts = {c[0]: left * c[2] // heavy for c in todo}
    extra = left - sum(parts.values())
    for name in sorted(parts)[:extra]:
        parts[name] += 1
    return take | parts
