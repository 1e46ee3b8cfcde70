"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np

SPACES = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, width):
    words = re.findall(SPACES, (text or "").translate(LOWER))
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_duplicates(texts: dict, width: int) -> dict:
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


def vector_groups(vectors: dict, labels: dict) -> dict:
    usable = {
        i: np.array(v, float) / max(map(abs, v)) for i, v in vectors.items()
        if labels[i] is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)
    }
    links = []
    for a in usable:
        for b in usable:
            if a < b and labels[a] == labels[b] and len(usable[a]) == len(usable[b]):
                x, y = usable[a], usable[b]
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links.append((a, b))
    n = Counter(x for pair in links for x in pair)
    return {i: (n[i], c) for i, c in components(vectors, links).items()}


def word_figures(text):
    text = text or ""
    words = re.findall(SPACES, text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if re.search(SPACES, line):
            repeated_lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated_lines,
            len(covered), failed)


def either_case(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
SECRETS = (
    ("assign", rf"""({ASSIGN})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)


def secrets(text):
    spans = sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern, group, least) in enumerate(SECRETS)
        for m in re.finditer(pattern, text or "") if len(m[group]) >= least
    )
    listed = [f"{kind}:{start}:{end}" for start, _, kind, end in spans]
    kinds = Counter(kind for _, _, kind, _ in spans)
    return (kinds["assign"], kinds["access"], kinds["hex"],
            hashlib.sha256(",".join(listed).encode()).hexdigest()), listed


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [
        (i, label) for phrase, label in PHRASES.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))
