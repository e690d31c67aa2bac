"""Plain reference results for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_components(rows):
    """rows: (doc_id, text). doc_id -> (n_shingles, component)."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    shared = {}
    for ids in where.values():
        for k, i in enumerate(ids):
            for j in ids[:k]:
                shared[j, i] = shared.get((j, i), 0) + 1
    for (i, j), common in shared.items():
        if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))
