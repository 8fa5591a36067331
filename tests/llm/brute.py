"""Plain single-machine forms of the operators, to compare with."""

import hashlib
import math
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_spans(text):
    out = []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[1]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def shingles(text, width=5):
    w = space_words((text or "").translate(LOWER))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def jaccard_components(docs):
    """docs: {doc_id: text} -> {doc_id: (n, component)}."""
    sets, parent, where = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}, {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j, v in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * v >= 75 * (len(s) + len(sets[j]) - v):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def removed_windows(docs, width=13):
    """docs: {doc_id: text} -> {doc_id: (n_words, n_removed, kept)}."""
    words, first, out = {i: space_words(t) for i, t in docs.items()}, {}, {}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k:k + width]), i)
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, width=13):
    """{doc_id: text}, {item_id: text} -> {doc_id: (n_words, n_hit, item ids)}."""
    windows = {}
    for item, text in items.items():
        w = alnum(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + width]), set()).add(item)
    sizes, out = {len(w) for w in windows}, {}
    for i, text in docs.items():
        w, hit, found = alnum(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k:k + n]))):
                    hit.update(range(k, k + n))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found))
    return out


def collocations(rows, least=30, top=2000, covered=80):
    """[(lang, text)] -> {(lang, phrase): (rank, a, l, r, n, score)}."""
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                count.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    found, around = {}, Counter()
    for (lang, p), a in count.items():
        if len(p) > 1 and a >= least:
            cuts = [(2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (score, a, count[lang, p[:k]], count[lang, p[k:]])
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[lang, p[i:i + m]] = max(around[lang, p[i:i + m]], a)
    out = {}
    for lang in n:
        own = [(-s, -a, " ".join(p).encode(), l, r) for (g, p), (s, a, l, r) in found.items() if g == lang and 100 * around[g, p] < covered * a]
        for rank, (s, a, phrase, l, r) in enumerate(sorted(own)[:top], 1):
            out[lang, phrase.decode()] = (rank, -a, l, r, n[lang], -s)
    return out


def _score(x, y):
    return min(max(sum(a * b for a, b in zip(x, y)), -2 ** 63), 2 ** 63 - 1)


def _whole(v, scale=256):
    return [int(min(max(math.floor(x * scale), -2 ** 62), 2 ** 62)) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def top_k(rows, is_query, k=5):
    """[(id, vector)] -> [(query_id, rank, id, score)]; of rows under one query id the first by vector is the query."""
    rows = [(i, v) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in rows if is_query(i)}):
        own = _whole(min(v for i, v in rows if i == q))
        found = sorted((-_score(own, _whole(v)), i) for i, v in rows if i != q and len(v) == len(own))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return out


def negatives(rows, is_anchor, positives=5, k=10):
    """[(id, label, vector)] -> [(anchor, positive, rank, negative, positive score, negative score)]."""
    rows = [(i, y, _whole(v)) for i, y, v in rows if i is not None and y is not None and usable(v)]
    out = []
    for a in sorted({i for i, _, _ in rows if is_anchor(i)}):
        _, label, own = min((i, y, v) for i, y, v in rows if i == a)
        scored = {(-_score(own, v), i, y) for i, y, v in rows if i != a and len(v) == len(own)}
        for s, p in sorted({(s, i) for s, i, y in scored if y == label})[:positives]:
            near = sorted({(t, i) for t, i, y in scored if y != label and -30 * s <= -100 * t <= -90 * s})[:k]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(near, 1)]
    return out


def byte_shingles(text, width=8):
    b = text.encode()
    return {b[i:i + width] for i in range(len(b) - width + 1)} if len(b) >= width else {b} - {b""}
