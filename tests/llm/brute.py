"""Plain reference forms of the operators, for small inputs only."""

from __future__ import annotations

import re


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components(ids, linked_pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in linked_pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    holders = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    pairs = set()
    for k, (_, s) in enumerate(sets):
        count = {}
        for g in s:
            for j in holders[g]:
                if j < k:
                    count[j] = count.get(j, 0) + 1
        for j, c in count.items():
            if 100 * c >= 80 * (len(s) + len(sets[j][1]) - c):
                pairs.add((sets[j][0], sets[k][0]))
    comp = components([i for i, _ in sets], pairs)
    return sorted((i, len(s), comp[i]) for i, s in sets)
