"""Near-duplicate classes by comparing everything, for small tables."""

import re
from collections import Counter


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def near_classes(rows):
    """Smallest key of the class of each row (doc_id, text); keys are distinct."""
    sets = {k: shingles(t) for k, t in rows}
    parent = {k: k for k, _ in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(parent)
    for n, a in enumerate(keys):
        size = sum(sets[a].values())
        for b in keys[:n]:
            other = sum(sets[b].values())
            if not size or not other or 5 * min(size, other) < 4 * max(size, other):
                continue
            common = sum((sets[a] & sets[b]).values())
            if 5 * common >= 4 * (size + other - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in keys}
