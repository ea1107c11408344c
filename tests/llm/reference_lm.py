"""A backoff model in plain dictionaries, which the operator is held against."""

import math
import zlib
from collections import Counter, defaultdict

SMOOTH, DISCOUNT, LEAST = 0.1, 0.5, 2
END = None


def tokens_of(text):
    return (text or "").encode().lower().split()


class Model:
    """Counts of learned texts (tokens, times each is there)."""

    def __init__(self, learned):
        one, two, three = Counter(), Counter(), Counter()
        for words, times in learned:
            s = [END, *words, END]
            for c, n in ((two, 2), (three, 3)):
                for g, m in Counter(zip(*(s[i:] for i in range(n)))).items():
                    c[g] += m * times
            for w in s[1:]:
                one[w] += times
        self.one, self.total, self.distinct = one, sum(one.values()), len(one)
        self.two = {g: c for g, c in two.items() if c >= LEAST}
        self.three = {g: c for g, c in three.items() if c >= LEAST}
        own, lower = defaultdict(float), defaultdict(float)
        for (a, b), c in self.two.items():
            own[a,] += (c - DISCOUNT) / one[a]
            lower[a,] += self.p1(b)
        for (a, b, w), c in self.three.items():
            own[a, b] += (c - DISCOUNT) / self.two[a, b]
            lower[a, b] += (self.two[b, w] - DISCOUNT) / one[b]
        self.alpha = {h: max(1 - own[h], 1e-12) / max(1 - lower[h], 1e-12) for h in own}

    def p1(self, w):
        return (self.one[w] + SMOOTH) / (self.total + SMOOTH * (self.distinct + 1))

    def p(self, w, history):
        if not history:
            return self.p1(w)
        if len(history) == 2 and (*history, w) in self.three:
            return (self.three[(*history, w)] - DISCOUNT) / self.two[history]
        if len(history) == 1 and (*history, w) in self.two:
            return (self.two[(*history, w)] - DISCOUNT) / self.one[history[0]]
        return self.alpha.get(history, 1.0) * self.p(w, history[1:])

    def score(self, words):
        s = [END, *words, END]
        return sum(math.log10(self.p(s[i], tuple(s[max(0, i - 2) : i]))) for i in range(1, len(s)))

    def base(self, words):
        return sum(math.log10(self.p1(w)) for w in [*words, END])


def model_of(rows):
    """Model of (doc_id, text, times it is there) under the operator's split."""
    return Model([(tokens_of(t), k) for d, t, k in rows if d is not None and zlib.crc32(str(d).encode()) % 10])
