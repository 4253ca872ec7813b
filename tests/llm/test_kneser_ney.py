import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from topicloom.llm import kneser_ney as Q
from topicloom.llm import textbytes as B

TEXTS = ["the cat sat on the mat.\nthe cat sat\n\nThe end", None, "", "a\na\n\na b\nb", "é é é é é é", "%% ## $$ <|>", "x y z x y z x y z", "\n\n", "über straße " * 40, "tail\n"]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    counts, hit, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if counts[g] > 1:
            hit |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


class Plain:
    """The model by definition, over dictionaries."""

    def __init__(self, texts):
        self.counts = {4: Counter()}
        self.symbols = [[0] * 3 + [int(Q.SYMBOL[b]) for b in (t or "").encode()] + [0] for t in texts]
        for s in self.symbols:
            self.counts[4].update(tuple(s[i - 3 : i + 1]) for i in range(3, len(s)))
        for m in (3, 2, 1):
            self.counts[m] = Counter(g[1:] for g in self.counts[m + 1])
        self.total, self.taken = defaultdict(float), defaultdict(float)
        self.cut = {}
        for m, c in self.counts.items():
            of = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
            y = of[0] / (of[0] + 2 * of[1]) if of[0] + of[1] else 0
            self.cut[m] = [0, *(min(max(i - (i + 1) * y * of[i] / of[i - 1], 0), i) if of[i - 1] else 0.5 * i for i in (1, 2, 3))]
            for g, v in c.items():
                self.total[m, g[:-1]] += v
                self.taken[m, g[:-1]] += self.cut[m][min(v, 3)]

    def p(self, gram):
        m = len(gram)
        if not m:
            return 1 / Q.ALPHABET
        if not self.total[m, gram[:-1]]:
            return self.p(gram[1:])
        v = self.counts[m][gram]
        own = (v - self.cut[m][min(v, 3)]) / self.total[m, gram[:-1]] if v else 0
        return own + max(self.taken[m, gram[:-1]] / self.total[m, gram[:-1]], 1e-12) * self.p(gram[1:])

    def log_perplexity(self, k):
        s = self.symbols[k]
        return -sum(math.log(self.p(tuple(s[i - 3 : i + 1]))) for i in range(3, len(s))) / (len(s) - 3)


@pytest.fixture(scope="module")
def built():
    held = [np.unique(Q.grams(d, o)[0], return_counts=True) for _, d, o in B.blocks(pa.array(TEXTS))]
    return Q.Model(*Q._merged(held)), Plain(TEXTS)


def test_counts_and_perplexity(built):
    own, plain = built
    for k, found in enumerate(Q.measure(own, pa.array(TEXTS)).to_pylist()):
        values = list(found.values())
        assert values[:5] == base(TEXTS[k])
        assert math.isclose(values[5], plain.log_perplexity(k), rel_tol=1e-9)


def test_unseen_grams_and_sums(built):
    own, plain = built
    for context in ((20, 8, 5), (7, 7, 7), (0, 0, 0), (61, 62, 63)):
        a, b, c = context
        codes = np.array([a << 18 | b << 12 | c << 6 | x for x in range(64)], np.uint32)
        p = np.exp(own.log_p(codes))
        assert math.isclose(p.sum(), 1, rel_tol=1e-9)
        assert np.allclose(p, [plain.p((*context, x)) for x in range(64)])


def test_spark_counts_are_those_of_all_texts(documents):
    found = {r.gram: r.n for r in Q.count_grams(documents(*enumerate(TEXTS))).collect()}
    assert found == {g[0] << 18 | g[1] << 12 | g[2] << 6 | g[3]: n for g, n in Plain(TEXTS).counts[4].items()}


def test_bands_reject_the_odd_one(documents, prose):
    rows = [(k, prose(120, k), "aa") for k in range(80)] + [(k, prose(120, k).upper(), None) for k in range(100, 140)]
    rows += [(900, "q#z%x " * 5 + " ".join(f"{a}{b}q%" for a in "zxqj" for b in "wvkyqzxjpmnbtr"), "aa"), (901, "few words", "aa"), (902, None, "aa"), (903, "same three words " * 40, "aa"), (904, "", None), (900, None, "bb")]
    found = Q.judge(documents(*rows))
    kept = {(r.doc_id, r.n_words): r.kept for r in found.collect()}
    assert found.count() == len(rows)
    assert all(v for (k, _), v in kept.items() if k < 900)
    assert not any(v for (k, _), v in kept.items() if k >= 900)
    failed = {r.doc_id for r in found.filter("base_failed").collect()}
    assert {901, 902, 903, 904} <= failed


def test_no_rows(documents):
    assert Q.judge(documents()).count() == 0
