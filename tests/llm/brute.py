"""Plain Python versions the operators are held against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower_az(text: str) -> bytes:
    return (text or "").encode().lower()


def words(text: str | None) -> list[bytes]:
    return SPACE_WORD.findall(lower_az(text or ""))


def shingle_set(text: str | None, k: int = 5) -> set:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicate_components(docs: dict, percent: int = 85) -> dict:
    sets = {d: shingle_set(t) for d, t in docs.items()}
    at, shared = defaultdict(list), Counter()
    for d in sorted(sets):
        for s in sets[d]:
            for other in at[s]:
                shared[other, d] += 1
            at[s].append(d)
    links = [
        (a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)
    ]
    root = components(docs, links)
    return {d: (len(sets[d]), root[d], root[d] == d) for d in docs}


def repeat_statistics(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts, marked = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            marked.update((i, i + 1, i + 2))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(marked)


def repeated_spans(docs: dict, min_words: int) -> tuple[dict, dict]:
    """Per document the maximal word spans of repeated passages, and of those that stand earlier."""
    places = defaultdict(list)
    for d in sorted(docs):
        w = words(docs[d])
        for i in range(len(w) - min_words + 1):
            places[tuple(w[i : i + min_words])].append((d, i))

    def merged(starts: dict) -> dict:
        out = {}
        for d, found in starts.items():
            spans = []
            for at in sorted(found):
                if spans and at <= spans[-1][1]:
                    spans[-1][1] = at + min_words
                else:
                    spans.append([at, at + min_words])
            out[d] = [(a, b - a) for a, b in spans]
        return out

    twice, later = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for n, (d, at) in enumerate(sorted(found)):
                twice[d].add(at)
                if n:
                    later[d].add(at)
    return merged(twice), merged(later)
