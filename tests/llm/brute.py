"""Plain definitions that the operators are compared with."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text, shingle=4):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits=4):
    """Component number of each fingerprint."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def repeats(texts, window=35):
    """(words, removed, digest of what is kept) of each text."""
    lists = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found)


def spans_text(spans):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def edit_distance_within(pattern, words):
    """Least number of word edits between the pattern and any part of the words."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for w in words:
        last, row[0] = 0, 0
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(last + (p != w), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def tokens(text):
    return [*WORD.findall(lower(text)), ""]


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


class Katz:
    def __init__(self, lists, discounts):
        self.uni, self.bi, self.after = Counter(), Counter(), defaultdict(set)
        for w in lists:
            self.uni.update(w)
            self.bi.update(zip(["", *w[:-1]], w))
        for h, w in self.bi:
            self.after[h].add(w)
        self.n = sum(self.uni.values())
        number = lambda c: [Counter(c.values())[r] for r in range(1, 7)]
        self.d1, self.d2 = discounts(number(self.uni)), discounts(number(self.bi))
        left = sum(c * (1 - self.d1[c]) for c in self.uni.values() if c <= 5) if self.n else 1
        self.base, self.unknown = (self.n, left / max(self.n, 1)) if left > 1e-9 else (self.n + 1, 1 / (self.n + 1))

    def p1(self, w):
        c = self.uni[w]
        return (self.d1[c] if c <= 5 else 1) * c / self.base if c else self.unknown

    def p(self, h, w):
        if h not in self.after:
            return self.p1(w)
        counts = [self.bi[h, x] for x in self.after[h]]
        total, left = sum(counts), sum(c * (1 - self.d2[c]) for c in counts if c <= 5)
        base, left = (total, left) if left > 1e-9 * total else (total + 1, 1)
        c = self.bi.get((h, w), 0)
        if c:
            return (self.d2[c] if c <= 5 else 1) * c / base
        return left / base / (1 - sum(self.p1(x) for x in self.after[h])) * self.p1(w)

    def score(self, w):
        return sum(math.log10(self.p(h, x)) for h, x in zip(["", *w[:-1]], w))


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows of (doc_id, source, lang, n_chars, text)."""
    def climb(nodes):
        """Levels from the nodes up, and what remains."""
        levels = [nodes]
        while len(nodes) > 1:
            nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
            levels.append(nodes)
        return levels

    def walk(levels, at, digest):
        """Siblings and the digest at the end, from a node on the lowest level."""
        beside = ""
        for nodes in levels[:-1]:
            first = at // 16 * 16
            run = nodes[first:first + 16]
            beside += "".join(d for i, d in enumerate(run) if first + i != at)
            run[at - first] = digest
            digest, at = sha("".join(run)), at // 16
        return beside, digest

    by_source = defaultdict(list)
    for row in rows:
        leaf = sha("".join(map(field, row)))
        new = leaf if row[0] is None or zlib.crc32(str(row[0]).encode()) % 5 else sha("".join(map(field, [*row[:4], None if row[4] is None else lower(row[4])])))
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf, new))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by_source[s])]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for number, s in enumerate(order):
        for at, (known, doc_id, leaf, new) in enumerate(sorted(by_source[s])):
            beside, digest = walk(trees[s], at, new)
            more, digest = walk(top, number, digest)
            out.append((doc_id if known else None, leaf, trees[s][-1][0], top[-1][0], sha(beside + more), digest, digest == top[-1][0]))
    return out


def trie(rows):
    """Nodes (conv_id, depth, parent, convs, children, leaves, saved, ends) of rows of (conv_id, turn, role, text)."""
    def digest(role, text):
        return sha(f"{len((role or '').encode())}:{role or ''}{text or ''}")

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", digest(role, text), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(turns)] for c, turns in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            nodes[tuple(whole[:d])].append((c, d == len(whole)))
    below = defaultdict(list)
    for n in nodes:
        if n:
            below[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in below[n]) or 1
        saved[n] = sum(saved[x] for x in below[n]) + (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0)
    return [(min(m)[0], len(n), min(nodes[n[:-1]])[0] if n else None, len(m), len(below[n]), leaves[n], saved[n],
             sha(",".join(str(c) for c in sorted(c for c, end in m if end)))) for n, m in nodes.items()]


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licenses(text, rules, weights):
    """(words, base places, first, last, base labels, labels, score): every pair of detections is compared."""
    words = LICENSE_WORD.findall(lower(text))
    base = [(i, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
            for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    line, spans = f" {' '.join(words)} ", []
    for number, rule in enumerate(rules):
        for m in re.finditer(f" (?:{rule.words})(?= )", line):
            spans.append((line.count(" ", 0, m.start()), line.count(" ", 0, m.end()), rule.tier, number, rule))
    told = [s for s in spans if s[4].base or not any(
        o[0] <= s[0] and o[1] >= s[1] and (o[2], s[1] - s[0] - (o[1] - o[0]), o[3]) < (s[2], 0, s[3]) for o in spans)]
    labels = {s[4].label for s in told} | {label for _, label in base}
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), max((weights[s[2]] for s in told), default=0.0))


def linked_spans(text, kinds, base, reach):
    """All reported spans (start, kind, stop): every pair of parts is compared. ``kinds``: (name, pattern, role)."""
    text = text or ""
    parts = []
    for number, (name, pattern, role) in enumerate(kinds):
        for m in re.finditer(pattern, text, re.ASCII):
            value = m.group(2) if name in ("assign", "short") else ""
            if name == "assign" and len(value) < 12 or name == "short" and len(value) >= 12:
                continue
            if name == "blob" and not (re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group())):
                continue
            parts.append((m.start(), number, m.end(), role == "secret"))

    def overlap(a, b):
        return a[0] < b[2] and b[0] < a[2]

    weak = [p for p in parts if p[1] >= base and not any(
        overlap(p, o) and (o[1] < base or p[3] and not o[3]) for o in parts if o is not p)]
    strong = [p for p in parts if p[1] < base]
    linked = [p for p in weak if any(p[3] != o[3] and not overlap(p, o) and p[0] - reach < o[2] and o[0] < p[2] + reach for o in strong + weak)]
    return sorted((a, k, b) for a, k, b, _ in strong + linked)
