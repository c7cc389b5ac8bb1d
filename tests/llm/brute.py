"""Plain versions of the operators' contracts, for small tables."""

import re
from collections import defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = str.maketrans(UPPER, LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        parent[find(a)] = find(b)
    groups = defaultdict(list)
    for n in nodes:
        groups[find(n)].append(n)
    return {n: min(g) for g in groups.values() for n in g}


def jaccard_components(texts, percent=80):
    """{id: (set size, smallest id reachable)} for a dict of texts."""
    sets = {i: shingles(t) for i, t in texts.items()}
    lists = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            lists[x].add(i)
    links = []
    for i, s in sets.items():
        for j in set().union(*(lists[x] for x in s)) if s else ():
            if j < i:
                common = len(s & sets[j])
                if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                    links.append((i, j))
    least = components(sets, links)
    return {i: (len(s), least[i]) for i, s in sets.items()}


def repeated_lines(texts, least=5):
    """{id: numbers of lines that go} for a dict of texts."""
    seen = [(i, n, tuple(words(line))) for i, t in sorted(texts.items()) for n, line in enumerate((t or "").split("\n"))]
    seen = [x for x in seen if len(x[2]) >= least]
    first, near, done = {}, set(), set()
    replaced, shorter = set(), set()
    for i, n, w in seen:
        if w in first:
            continue
        first[w] = (i, n)
        cut = [w[:j] + w[j + 1 :] for j in range(len(w))]
        if any((v, j) in replaced or v in done for j, v in enumerate(cut)) or w in shorter:
            near.add(w)
        replaced.update((v, j) for j, v in enumerate(cut))
        shorter.update(cut)
        done.add(w)
    goes = defaultdict(set)
    for i, n, w in seen:
        if first[w] != (i, n) or w in near:
            goes[i].add(n)
    return goes


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOW))


def contaminated(docs, items, window=10):
    """(id, words, words hit, item ids) of each (id, text)."""
    grams = defaultdict(set)
    for i, t in items:
        w = benchmark_words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            grams[tuple(w[a : a + k])].add(i)
    sizes = {len(g) for g in grams}
    for i, t in docs:
        w, hit, found = benchmark_words(t), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if x := grams.get(tuple(w[a : a + k])):
                    found |= x
                    hit |= set(range(a, a + k))
        yield i, len(w), len(hit), sorted(map(str, found))
