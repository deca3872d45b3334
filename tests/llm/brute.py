"""Plain single-machine versions of the operators, to compare with. Rows are (doc_id, text)."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

LAST = 1 << 62


def sha(data):
    return hashlib.sha256(data).hexdigest()


def words_of(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def quality(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.encode().strip()]
    return {"n_words": len(words), "word_chars": sum(len(w.decode()) for w in words),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_lines": len(lines),
            "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)), "n_repeat_words": len(covered),
            "n_distinct_words": len(set(words)),
            "n_wordless": sum(all(33 <= c < 127 and not chr(c).isalpha() for c in w) for w in words)}


def failed(m):
    return [m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"], 10 * m["n_symbols"] > m["n_words"],
            10 * m["n_dup_lines"] > 4 * m["n_lines"], m["word_chars"] < 3 * m["n_words"], m["word_chars"] > 10 * m["n_words"],
            100 * m["n_distinct_words"] < 20 * m["n_words"], 10 * m["n_wordless"] > 3 * m["n_words"]]


def dropped_lines(rows, least=10):
    split = [[(line, line.strip().lower()) for line in (t or "").encode().split(b"\n")] for _, t in rows]
    seen = Counter(k for lines in split for k in {k for _, k in lines})
    return [(len(lines), [line for line, k in lines if not k or seen[k] < least]) for lines in split]


def language_model(rows, bigram):
    tokens = [words_of(t, True) + [None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    uni, pairs, starts = Counter(), Counter(), 0
    for w, h in zip(tokens, held):
        if not h:
            uni.update(w)
            pairs.update(zip([0, *w[:-1]], w))
            starts += 1
    n, v, out = sum(uni.values()), len(uni), []
    for w, h in zip(tokens, held):
        base = score = 0.0
        for before, word in zip([0, *w[:-1]], w):
            p, state = (uni[word] + 1) / (n + v + 1), starts if before == 0 else uni[before]
            base += math.log10(p)
            score += math.log10(bigram * pairs[before, word] / state + (1 - bigram) * p if state else p)
        out.append((h, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def shingles(text):
    w = words_of(text, True)
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """Component (smallest row index) of every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b, small, large = sets[j], *sorted((len(a), len(sets[j])))
            if a and b and small * 5 >= large * 4:
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(rows))], [len(s) for s in sets]


def earlier_passages(rows, width=50):
    first = defaultdict(lambda: LAST)
    split = [words_of(t) for _, t in rows]
    ids = [LAST if i is None else i for i, _ in rows]
    for i, w in zip(ids, split):
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first[key], i)
    out = []
    for i, w in zip(ids, split):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def smallest_capacity(sizes, parts):
    def needed(capacity):
        n, held = 1, 0
        for x in sizes:
            if held + x > capacity:
                n, held = n + 1, 0
            held += x
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= parts else (middle + 1, high)
    return low
