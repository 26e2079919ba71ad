"""Plain versions of the contracts, word by word."""

import re
from collections import Counter, defaultdict
from itertools import combinations

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base_counts(text):
    ws = words(text)
    seen = Counter(tuple(ws[k : k + 5]) for k in range(len(ws) - 4))
    covered = {k + j for k in range(len(ws) - 4) if seen[tuple(ws[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered)


def removed_words(rows, window=13):
    """{position of row: set of removed word numbers}; a null id is the largest."""
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        ws = words(rows[i][1])
        at = (rows[i][0] is None, rows[i][0] or 0)
        for k in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[k : k + window]), at)
    out = {}
    for i in order:
        ws, at = words(rows[i][1]), (rows[i][0] is None, rows[i][0] or 0)
        out[i] = {
            k + j
            for k in range(len(ws) - window + 1)
            if first[tuple(ws[k : k + window])] < at
            for j in range(window)
        }
    return out


def hits(items, texts, window=10):
    """[(words, hit words, item names)] of each text; items without name have hits only."""
    phrases = defaultdict(set)
    for name, text in items:
        ws = item_words(text)
        size = min(window, len(ws))
        for k in range(len(ws) - size + 1) if size else ():
            phrases[tuple(ws[k : k + size])] |= set() if name is None else {str(name)}
    sizes = sorted({len(p) for p in phrases})
    out = []
    for text in texts:
        ws, hit, names = item_words(text), set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                if (found := phrases.get(tuple(ws[k : k + size]))) is not None:
                    names |= found
                    hit.update(range(k, k + size))
        out.append((len(ws), hit, names))
    return out


def bag(text):
    ws = words(text)
    return Counter(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else Counter()


def similarity(a, b):
    shared = sum(min(n, b[s]) for s, n in a.items())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def near_classes(rows, least=0.8):
    """{doc_id: smallest doc_id of its class} for unique ids."""
    bags = {i: bag(t) for i, t in rows}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = defaultdict(set)
    for i, b in bags.items():
        for s in b:
            by[s].add(i)
    for a, b in sorted({p for ids in by.values() for p in combinations(sorted(ids), 2)}):
        if similarity(bags[a], bags[b]) >= least and root(a) != root(b):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in bags}
