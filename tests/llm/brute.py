"""Brute-force versions of the operators' contracts, in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(_LOWER)


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)} of (id, text) pairs."""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i:i + n])].add(item)
    sizes = {len(k) for k in windows}
    out = {}
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in windows[tuple(w[i:i + n])] if x is not None}
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def secrets(text):
    """Base spans (start, kind, end)."""
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{a}:{b}" for a, k, b in spans)


def shingles(text):
    w = SPACED.findall(lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


class Groups:
    def __init__(self):
        self.top = {}

    def find(self, x):
        self.top.setdefault(x, x)
        while self.top[x] != x:
            x = self.top[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.top[max(a, b)] = min(a, b)


def near_documents(docs):
    """{doc_id: (n_shingles, component_id)}, comparing all documents that share a shingle."""
    groups, where, sets = Groups(), defaultdict(list), {d: shingles(t) for d, t in docs}
    for d, s in sets.items():
        for e, n in Counter(e for g in s for e in where[g]).items():
            if 100 * n >= 75 * (len(s) + len(sets[e]) - n):
                groups.link(d, e)
        for g in s:
            where[g].append(d)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def unigrams(docs):
    """{doc_id: (n_tokens, n_known, train_tokens, base_score)}"""
    tokens = {d: [*SPACED.findall(lower(t)), None] for d, t in docs}
    counts = Counter(x for d, t in tokens.items() if fold(d, 7) != 2 for x in t)
    n, v = sum(counts.values()), len(counts)
    return {d: (len(t), sum(counts[x] > 0 for x in t), n, math.fsum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)) for d, t in tokens.items()}


def normal_line(line):
    return re.sub("[0-9]+", "0", re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line.lower())).strip(" ")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kept_lines(docs, keys=None, similarity=0.9):
    """{(row, line_no)} that stay; docs: (doc_id, text) rows; keys: {normal form: set}, of which two
    linked lines share one (None: any two similar lines are linked)."""
    groups, forms = Groups(), sorted({normal_line(x) for _, t in docs for x in (t or "").split("\n")} - {""})
    for i, a in enumerate(forms):
        for b in forms[:i]:
            if (keys is None or keys[a] & keys[b]) and edit_distance(a, b) <= math.floor(max(len(a), len(b)) * (1 - similarity) + 1e-9):
                groups.link(a, b)
    first, kept = {}, set()
    rows = sorted((d is None, d if d is not None else 0, k, r, line) for r, (d, t) in enumerate(docs) if t is not None for k, line in enumerate(t.split("\n")))
    for _, _, k, r, line in rows:
        form = normal_line(line)
        if not form or first.setdefault(groups.find(form), (r, k)) == (r, k):
            kept.add((r, k))
    return kept
