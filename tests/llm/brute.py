"""Plain statements of the operators' results, row by row, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    chars = sum(map(len, words))
    n, symbols = len(words), len(re.findall(r"[#*$%&|<>]", text))
    base = n < 50 or 100 * len(hit) > 50 * n
    upper, bangs = len(re.findall("[A-Z]", text)), text.count("!")
    kept = not (base or 100 * symbols > 10 * n or chars < 2 * n or chars > 15 * n or 100 * dup > 30 * len(lines)
                or 100 * upper > 50 * chars or 100 * bangs > 30 * n)
    return n, chars, symbols, dup, len(hit), base, kept


def repeats(texts, length=200):
    """Per text: bytes, removed bytes, spans, hash of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def boilerplate(rows, min_sites=10):
    """Per (site, text): text left, lines, lines removed."""
    sites, texts = defaultdict(set), defaultdict(set)
    for site, text in rows:
        for x in (text.split("\n") if text is not None else ()):
            if WORD.search(x):
                sites[x].add(site)
                texts[x].add(text)
    bad = {x for x in sites if len(sites[x]) >= min_sites and len(texts[x]) > 1}
    out = []
    for _, text in rows:
        lines = text.split("\n") if text is not None else []
        left = [x for x in lines if x not in bad]
        out.append((None if text is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return out


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts, items, window=10):
    words_of = lambda t: BENCH_WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k:k + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for text in texts:
        words, hit, found = words_of(text), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), digest, bool(hit)))
    return out


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, distance=3):
    """(id, fingerprint) rows to the least id reachable."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(rows))]


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def personal(text):
    out, counts = [], []
    for kind, pattern in KINDS.items():
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.findall("[0-9]", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                    "card": 13 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
                n += 1
        counts.append(n)
    return (*counts, hashlib.sha256(",".join(out).encode()).hexdigest())


def crossed(rows, group=5, shared=9):
    """Turns (role, text) per conversation, rebuilt; rows are (conv_id, turn, role, text)."""
    name = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % shared
        base = c - int(math.fmod(c, group))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def trie(talks):
    """Rows (conv_id, depth, parent, members, children, leaves, saved, ends) of every distinct prefix."""
    members = defaultdict(list)
    for c in sorted(talks):
        for d in range(len(talks[c]) + 1):
            members[tuple(talks[c][:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [(q, x) for q, x in members.items() if q[:len(p)] == p]
        saved = sum((len(x) - 1) * len(q[-1][1].encode()) for q, x in below if q)
        ends = ",".join(str(c) for c in m if len(talks[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p],
                    sum(not kids[q] for q, _ in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def variants(docs, min_chars=5, min_count=3, ratio=2, typo=97):
    """Rows (word, form, root, n, n_near, form_n); docs are (doc_id, text)."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % typo == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= min_chars and k >= min_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    forms, found = {}, {}
    for w in n:
        found[w] = [v for v in n if near(w, v)]
        best = min(found[w], key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n[w], len(found[w]), n[forms[w]] if forms[w] else None))
    return sorted(out, key=str)
