"""Plain Python versions of the contracts, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(UP) if lower else text)


def near_duplicates(docs, bound=85):
    """{doc_id: (n_shingles, component_id, kept)} of {doc_id: text}."""
    sets = {}
    for i, text in docs.items():
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = Counter((a, b) for who in holders.values() for a in who for b in who if a < b)
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= bound * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in docs}


def _discounts(counts):
    c = [sum(v == k for v in counts) for k in (1, 2, 3, 4)]
    y = c[0] / (c[0] + 2 * c[1]) if c[0] else 0.5
    d = [k - (k + 1) * y * c[k] / c[k - 1] if c[k - 1] else k / 2 for k in (1, 2, 3)]
    d = [x if 0 < x <= k else k / 2 for k, x in zip((1, 2, 3), d)]
    return lambda n: 0 if n == 0 else d[min(n, 3) - 1]


class KneserNey:
    """Interpolated modified Kneser-Ney of order two over documents, with words as they are."""

    def __init__(self, docs):
        self.words, self.pairs = Counter(), Counter()
        for text in docs:
            tokens = [*words(text), "\n"]
            self.words.update(tokens)
            self.pairs.update(zip([""] + tokens, tokens))
        self.before, self.after = Counter(w for _, w in self.pairs), defaultdict(list)
        self.seen = Counter()
        for (v, _), n in self.pairs.items():
            self.after[v].append(n)
            self.seen[v] += n
        self.d, self.e = _discounts(self.pairs.values()), _discounts(self.before.values())
        self.rest = sum(map(self.e, self.before.values())) / max(1, len(self.pairs)) if self.pairs else 1.0

    def lower(self, w):
        k = self.before[w]
        return max(k - self.e(k), 0) / max(1, len(self.pairs)) + self.rest / (len(self.words) + 1)

    def p(self, v, w):
        if not self.seen[v]:
            return self.lower(w)
        c = self.pairs[v, w]
        gamma = sum(map(self.d, self.after[v])) / self.seen[v]
        return max(c - self.d(c), 0) / self.seen[v] + gamma * self.lower(w)


def lm_scores(docs):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score, score)} of {doc_id: text}."""
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    model = KneserNey(t for i, t in docs.items() if not held[i])
    total, size = sum(model.words.values()), len(model.words)
    out = {}
    for i, text in docs.items():
        tokens = [*words(text), "\n"]
        base = sum(math.log10((model.words[w] + 1) / (total + size + 1)) for w in tokens)
        score = sum(math.log10(model.p(v, w)) for v, w in zip([""] + tokens, tokens))
        out[i] = (held[i], len(tokens), sum(model.words[w] > 0 for w in tokens), total, base, score)
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} of {source: size}, by rounds: cap what is above, share the rest again."""
    from fractions import Fraction

    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    free, rest, out = set(order), sum(sizes.values()), {}
    while free:
        total = sum(weight[s] for s in free)
        share = {s: Fraction(rest * weight[s], total) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return out | share
        for s in above:
            out[s] = Fraction(most * sizes[s])
            rest -= most * sizes[s]
        free -= above
    return out


def mix(docs, seed=7, most=3):
    """{doc_id: (size, source_size, target, taken)} of {doc_id: (text, source)}, one queue after the other merged."""
    import struct

    import xxhash

    def draw(i):
        first = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        return xxhash.xxh64_intdigest(struct.pack("<q", i), first) >> 1

    size = {i: len(words(t)) for i, (t, _) in docs.items()}
    of = {i: s for i, (_, s) in docs.items()}
    total = Counter()
    for i, s in of.items():
        total[s] += size[i]
    target = {s: float(t) for s, t in targets(total).items()}
    entries, upto = [], Counter()
    for i in sorted(docs, key=draw):
        upto[of[i]] += size[i]
        for e in range(most):
            if size[i]:
                entries.append(((e * total[of[i]] + upto[of[i]]) / target[of[i]], draw(i), e, i))
    taken, budget = Counter(), sum(size.values())
    for _, _, _, i in sorted(entries):
        budget -= size[i]
        if budget < 0:
            break
        taken[i] += size[i]
    return {i: (size[i], total[of[i]], target[of[i]], taken[i]) for i in docs}


def contaminated(docs, items):
    """{doc_id: (n_words, n_hit, items)} of {doc_id: text} and {item_id: text}."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall((t or "").translate(UP))
    grams = defaultdict(set)
    for i, text in items.items():
        w = split(text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            grams[tuple(w[k : k + size])].add(str(i))
    out = {}
    for i, text in docs.items():
        w, hit, found = split(text), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                names = grams.get(tuple(w[k : k + size]))
                if names:
                    hit |= set(range(k, k + size))
                    found |= names
        out[i] = (len(w), len(hit), sorted(found))
    return out
