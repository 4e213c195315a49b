"""Plain versions that several test files compare with."""

import re

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
            "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    """kind:start:end of the base kinds, by kind, then start."""
    def ok(k, m):
        digits = re.sub("[^0-9]", "", m)
        return {"ip": lambda: all(int(p) <= 255 for p in m.split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15}.get(k, lambda: True)()
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items()
            for m in re.finditer(p, text or "") if ok(k, m.group())]


def plain_components(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5
                    else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    low_id = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low_id[root(i)] = min(d, low_id.get(root(i), d))
    return [(d, len(sets[i]), low_id.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
