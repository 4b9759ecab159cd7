"""Plain versions that several tests compare with."""

from __future__ import annotations

from dqloom.llm import near_dup


def plain_sets(texts):
    out = []
    for text in texts:
        words = (text or "").encode().translate(near_dup.LOWER).split()
        out.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return out


def plain_groups(rows):
    """Smallest id reachable, by comparing all pairs."""
    sets = plain_sets([t for _, t in rows])
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets)]


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out
