"""Plain versions of the contracts, for small tables."""

import hashlib
import itertools
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def digest(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def repeats(texts, width=35):
    """(n_words, n_removed, digest of what stays) of each text."""
    words = [WORD.findall(t or "") for t in texts]
    uses = Counter(tuple(w[i: i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - width + 1) if uses[tuple(w[i: i + width])] > 1 for j in range(i, i + width)}
        out.append((len(w), len(gone), digest([x for i, x in enumerate(w) if i not in gone])))
    return out


def shingles(text, size=5):
    w = WORD.findall(fold(text))
    return {tuple(w[i: i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near(rows):
    """(n_shingles, component) of each (id, text); rows with a null id have none."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(len(s), None if k is None else least[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def contaminated(text, items, span=13):
    """(n_words, n_hit, items, verdict) of a text."""
    w, hit, found = ALNUM.findall(fold(text)), set(), set()
    for item, body in items:
        b = ALNUM.findall(fold(body))
        size = min(span, len(b))
        windows = {tuple(b[i: i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1) if b else ():
            if tuple(w[i: i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    uses, inside = Counter(zip(w, w[1:], w[2:])), set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if uses[g] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)
