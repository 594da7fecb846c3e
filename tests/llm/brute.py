"""Plain versions of the operators, on lists of rows."""

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def decontaminate(texts, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        if w and item is not None:
            n = min(len(w), window)
            for i in range(len(w) - n + 1):
                grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(map(str, found))).encode()), bool(hit)))
    return out


def without_spans(text, items, window=10):
    """The text without the words of hit windows and what stands before them."""
    grams = set()
    for item, t in items:
        w = words(t)
        if w and item is not None:
            grams |= {tuple(w[i : i + min(window, len(w))]) for i in range(len(w) - min(window, len(w)) + 1)}
    w, gone = words(text), set()
    for n in {len(g) for g in grams}:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in grams:
                gone.update(range(i, i + n))
    if not gone:
        return text
    out, end = [], 0
    for i, m in enumerate(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)):
        if i not in gone:
            out.append(text[end : m.end()])
        end = m.end()
    return "".join(out) + text[end:]


def shingles(text):
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def near_duplicates(rows):
    """rows: (doc_id, text); per row size of the set, component and kept."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            if a is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            least[root(i)] = min(a, least.get(root(i), a))
    out = []
    for i, (a, _) in enumerate(rows):
        component = None if a is None else least[root(i)]
        out.append((a, len(sets[i]), component, a is None or component == a))
    return out


def repeats(rows, length=50):
    """rows: (doc_id, text); per row bytes, removed, runs and the kept bytes' digest."""
    first = {}
    for a, text in rows:
        data = (text or "").encode()
        if a is not None:
            for i in range(len(data) - length + 1):
                s = data[i : i + length]
                first[s] = min(a, first.get(s, a))
    out = []
    for a, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if a is not None and first[data[i : i + length]] < a:
                gone[i : i + length] = b"\x01" * length
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out.append((a, len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g))))
    return out


def cross_parse(text, learned, normal):
    """Phrases of the greedy parse of ``normal`` text by substrings of ``learned``."""
    n, i = 0, 0
    while i < len(normal):
        j = i + 1
        while j <= len(normal) and normal[i:j] in learned:
            j += 1
        i = max(j - 1, i + 1)
        n += 1
    return n
