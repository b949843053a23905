"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def contamination(docs, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = cut(text)
        k = min(len(w), window)
        for s in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[s:s + k])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = cut(text), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if (got := tuple(w[s:s + k])) in windows:
                    hit |= set(range(s, s + k))
                    found |= windows[got]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def quality(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, again = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        inside = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
        out.append((doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(inside),
                    len(w) < 10 or 100 * len(inside) > 20 * len(w)))
    return out


def removed(docs, length=50):
    first = {}
    big = float("inf")
    for doc, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            first[s] = min(first.get(s, big), big if doc is None else doc)
    out = []
    for doc, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (big if doc is None else doc):
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def secrets(text):
    """(start, end, kind) of the base findings, by a scan of every place."""
    text = text or ""
    found = []
    for kind, pattern in enumerate((
            r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
            r"""["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", "AKIA[A-Z0-9]+", "[0-9a-f]+")):
        at = 0
        while m := re.compile(pattern).search(text, at):
            at = m.end()
            value = m.group(2) if kind == 0 else m.group()
            if len(value) >= (6, 20, 24)[kind]:
                found.append((m.start(), m.end(), kind))
    return sorted(found)


def fingerprint(text, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(docs):
    marks = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, f"{marks[i]:016x}", least[find(i)]) for i, (doc, _) in enumerate(docs)]


def fold(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 5


def base_scores(docs):
    from math import log10

    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]
    count = Counter(x for doc, text in docs if fold(doc) != 1 for x in cut(text))
    n, v = sum(count.values()), len(count)
    return [(doc, fold(doc) == 1, len(t := cut(text)), sum(count[x] > 0 for x in t), n,
             sum(log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)) for doc, text in docs]


def ppm_scores(docs, order=4):
    """log10 probability by the textbook recursion with symbol exclusion."""
    from math import log10

    trie = [defaultdict(Counter) for _ in range(order + 1)]
    stream = lambda text: [0] * order + list((text or "").encode()) + [256]
    for doc, text in docs:
        if fold(doc) != 1:
            s = stream(text)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    trie[k][tuple(s[i - k:i])][s[i]] += 1

    def chance(context, symbol):
        p, excluded = 1.0, set()
        for k in range(order, -1, -1):
            seen = {x: n for x, n in trie[k][tuple(context[order - k:])].items() if x not in excluded}
            total, kinds = sum(seen.values()), len(seen)
            if k == 0 and len(trie[0][()]) >= 257:
                kinds = 0
            if symbol in seen:
                return p * seen[symbol] / (total + kinds)
            if total:
                p *= kinds / (total + kinds)
            excluded |= set(seen)
        return p / (257 - len(excluded))

    out = []
    for _, text in docs:
        s = stream(text)
        out.append(sum(log10(chance(s[i - order:i], s[i])) for i in range(order, len(s))))
    return out


def spelling(docs):
    """``(word, form, root, n, n_near, form_n)`` by trying every edit."""
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters = {c for w in words for c in w}

    def near(w):
        out = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters} | {w[:i] + w[i + 1:] for i in range(len(w))}
        return [x for x in out - {w} if x in words]

    found = {w: near(w) for w in words}
    best = {w: min(x, key=lambda y: (-words[y], y)) for w, x in found.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return [(w, form.get(w), root(w), n, len(found[w]), words.get(form.get(w))) for w, n in words.items()]


def ranked(docs, items, k=10):
    """``(item_id, rank, doc_id, score)`` by scoring every document."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    counts = [Counter(cut(t)) for _, t in docs]
    n_docs, total = sum(map(bool, counts)), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in enumerate(counts):
            m = 100 - 90 + 90 * c.total() * n_docs // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(cut(text)) if c[t])
            if score > 0:
                scored.append((-score, docs[i][0] is None, docs[i][0] or 0, i))
        out += [(item, r + 1, docs[i][0], -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return out


def chain(scores, transitions):
    """Label probabilities of a short chain by summing over all labellings."""
    k, steps = len(transitions), len(scores)
    out = [[0.0] * k for _ in range(steps)]
    for labels in itertools.product(range(k), repeat=steps):
        p = sum(math.exp(transitions[i][labels[0]]) for i in range(k))
        for t, y in enumerate(labels):
            p *= math.exp(scores[t][y] + (transitions[labels[t - 1]][y] if t else 0))
        for t, y in enumerate(labels):
            out[t][y] += p
    return [[x / sum(row) for x in row] for row in out]
