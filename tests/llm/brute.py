"""Plain versions of operators, for small tables."""

import re
from collections import defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_components(rows, num=75, den=100):
    """[(doc_id, n_shingles, component_id)], by an inverted index over all shingles."""
    sets = [shingles(t) for _, t in rows]
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in lists[x]:
                if j < i:
                    shared[j] += 1
        for j, both in shared.items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
