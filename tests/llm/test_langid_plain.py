"""The n-gram tables against interpolated Kneser-Ney by plain counting."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np

from caseloom.llm import langid


class Plain:
    """One language: counts of the top order, of different characters before below it, one discount for each order."""

    def __init__(self, code: list[int], alphabet: int) -> None:
        self.alphabet = alphabet
        whole = {n: Counter(tuple(code[i : i + n]) for i in range(len(code) - n + 1)) for n in range(1, langid.ORDER + 1)}
        self.count = {langid.ORDER: whole[langid.ORDER]}
        for n in range(langid.ORDER - 1, 0, -1):
            before = defaultdict(set)
            for g in whole[n + 1]:
                before[g[1:]].add(g[0])
            self.count[n] = {g: max(1, len(before[g])) for g in whole[n]}
        self.discount, self.total, self.kinds = {}, {}, {}
        for n, c in self.count.items():
            once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            self.discount[n] = once / (once + 2 * twice) if once else 0.5
            self.total[n], self.kinds[n] = Counter(), Counter()
            for g, v in c.items():
                self.total[n][g[:-1]] += v
                self.kinds[n][g[:-1]] += 1

    def prob(self, gram: tuple[int, ...]) -> float:
        n, d = len(gram), self.discount[len(gram)]
        total = self.total[n][gram[:-1]]
        if n == 1:
            return max(self.count[1].get(gram, 0) - d, 0) / total + d * self.kinds[1][()] / total / self.alphabet
        lower = self.prob(gram[1:])
        if not total:
            return lower
        return max(self.count[n].get(gram, 0) - d, 0) / total + d * self.kinds[n][gram[:-1]] / total * lower


def test_log_probabilities_equal_plain_kneser_ney():
    r = random.Random(3)
    words = {"aa": "the cat sat on a mat and that was it".split(), "bb": "der hund und die katze süß sind hier".split()}
    texts, langs = [], []
    for _ in range(60):
        lang = r.choice(sorted(words))
        texts.append(" ".join(r.choice(words[lang]) for _ in range(r.randint(1, 12))))
        langs.append(lang)
    model = langid.train(texts, langs)
    fit = {}
    for lang in words:
        mine = [t for t, x in zip(texts, langs) if x == lang]
        fit[lang] = langid.characters([t for i, t in enumerate(mine, 1) if i % 5])[0].tolist()
    alphabet = len({c for code in fit.values() for c in code}) + 1
    plain = [Plain(fit[lang], alphabet) for lang in model.languages]
    asked = ["the hund sat", "süß, zzz 12 und", "q", "die katze and the mat", "中文 the"]
    code, begin, end, _ = langid.characters(asked)
    got = model.log_prob(code)
    ce, n, _ = model.score(asked)
    for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
        want = np.array([[math.log(p.prob(tuple(code[k - langid.ORDER + 1 : k + 1].tolist()))) for p in plain] for k in range(a, b)])
        assert np.abs(got[a:b] - want).max() < 2e-4
        assert np.abs(ce[i] + want.mean(axis=0)).max() < 2e-4 and n[i] == b - a


def test_probabilities_of_a_context_sum_to_one():
    code = langid.characters(["abab cab ba", "cc ab"])[0].tolist()
    p = Plain(code, len(set(code)) + 1)
    for context in {tuple(code[i : i + 4]) for i in range(len(code) - 4)}:
        seen = sum(p.prob((*context, c)) for c in set(code))
        assert abs(seen + p.prob((*context, 0x10FFFF)) - 1) < 1e-9
