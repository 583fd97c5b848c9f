"""Brute-force versions of the operators, for small tables."""
import hashlib
import re
from collections import Counter

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def quality(text):
    w = words(text)
    text = text or ""
    windows = Counter(zip(w, w[1:], w[2:]))
    again = {i + d for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again)}


def substring(rows, window=50):
    """rows of (doc_id, text) -> list of (doc_id, n_words, n_removed, sha256 of the kept words)."""
    last = 1 << 63
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, last), last if doc is None else doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (last if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, n=5):
    w = words(lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def components(rows):
    """rows of (doc_id, text) -> list of (doc_id, n_shingles, component)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] or doc is None else doc) for i, (doc, _) in enumerate(rows)]


def licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    places = [(i, label) for phrase, label in phrases.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return {"n_words": len(w), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted({x for _, x in places}))}
