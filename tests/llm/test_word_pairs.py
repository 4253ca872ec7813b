import math
import random
import re
from collections import Counter

import numpy as np

from topicloom.llm import kneser_ney as Q
from topicloom.llm import word_pairs as P

TEXTS = ["The cat sat on the mat. the cat sat", "the cat sat on a hat", "the cat sat on a hat", None, "", "a dog sat on the mat and the cat ran", "über straße über STRASSE über straße", "one", "xq zv kw", "\n \t"]


def pairs_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return list(zip([None, *words], [*words, None]))


def by_definition(texts):
    """Losses from dictionaries; the counts of a text are those of all others, the discounts those of all."""
    whole = Counter(g for t in texts for g in pairs_of(t))

    def cuts(counts):
        of = [sum(v == i for v in counts.values()) for i in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1]) if of[0] + of[1] else 0
        return [0, *(min(max(i - (i + 1) * y * of[i] / of[i - 1], 0), i) if of[i - 1] else 0.5 * i for i in (1, 2, 3))]

    single = Counter(w for _, w in whole)
    cut, cut_single, lone = cuts(whole), cuts(single), 1 / (len(single) + 1)
    out = []
    for t in texts:
        own = Counter(pairs_of(t))
        left = {g: v - own[g] for g, v in whole.items() if v > own[g]}
        before = Counter(w for _, w in left)

        def low(w):
            if not left:
                return lone
            free = sum(cut_single[min(v, 3)] for v in before.values())
            return (before[w] - cut_single[min(before[w], 3)] + max(free, 1e-12) * lone) / len(left)

        loss = 0.0
        for v, w in pairs_of(t):
            after = [n for g, n in left.items() if g[0] == v]
            p = low(w)
            if after:
                n = left.get((v, w), 0)
                p = (n - cut[min(n, 3)] + max(sum(cut[min(x, 3)] for x in after), 1e-12) * p) / sum(after)
            loss -= math.log(p)
        out.append(loss / len(pairs_of(t)))
    return out


def losses(docs):
    docs = docs.select("doc_id", "text")
    return {r[0]: v for rows, found in P.with_losses(docs).collect() for r, v in zip(rows, found.tolist())}


def test_packed_numbers():
    for values in ([], [0], [0, 0, 0], [1, 255, 256], [2**64 - 1, 5], list(range(70_000))):
        assert P.unpack(P.pack(np.array(values, np.uint64))).tolist() == values


def test_losses_by_definition_in_any_partitions(documents, monkeypatch):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice("ab bc cd de ef fg gh".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    expected = by_definition(texts)
    docs = documents(*enumerate(texts))
    for parts, size in ((1, 1 << 20), (3, 200), (7, 1)):  # one chunk, some, one for each text
        monkeypatch.setattr(P, "CHUNK_BYTES", size)
        found = losses(docs.repartition(parts, "doc_id").select("*"))
        assert len(found) == len(texts)
        assert np.allclose([found[k] for k in range(len(texts))], expected, rtol=1e-9)


def test_few_texts(documents):
    assert losses(documents()) == {}
    found = losses(documents((1, None)))
    assert found.keys() == {1} and math.isclose(found[1], by_definition([None])[0])


def test_shuffled_words_leave_the_band(documents):
    """Ordinary texts stay, the same words in another order go, though their characters are the same."""
    rng = random.Random(3)
    words = [f"{a}{b}{c}o" for a in "bdfgk" for b in "aeiu" for c in "lmnrs"]

    def text():  # five words may follow each
        at, out = rng.randrange(100), []
        for _ in range(120):
            out.append(words[at])
            at = (7 * at + rng.choice((1, 12, 33, 51, 74))) % 100
        return out

    ordinary = [text() for _ in range(120)]
    shuffled = [rng.sample(t, len(t)) for t in ordinary[:4]]
    rows = [(k, " ".join(t), "aa") for k, t in enumerate(ordinary + shuffled)] + [(500 + k, " ".join(ordinary[0]), "aa") for k in range(3)]
    found = {r.doc_id: r for r in Q.judge(documents(*rows)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert sorted(k for k, r in found.items() if not r.kept) == [120, 121, 122, 123]
    for k in range(120, 124):  # its characters alone do not tell
        assert found[k].low <= found[k].log_perplexity <= found[k].high
    assert all(math.isclose(found[k].word_log_perplexity, found[0].word_log_perplexity) for k in (500, 501, 502))


def test_sorted_hashes_cost_no_more_than_their_gaps_hold():
    """The first bytes of the gaps are compressed though the others cannot be."""
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << P.BITS, 9_000).astype(np.uint64))
    gaps = np.diff(keys)
    assert P.unpack(P.pack(gaps)).tolist() == gaps.tolist()
    width = (int(gaps.max()).bit_length() + 7) // 8
    assert len(P.pack(gaps)) < (width - 0.2) * len(gaps)


def test_numbered_as_by_unique():
    rng = np.random.default_rng(2)
    for bound in (1, 7, 1 << 30, 1 << 62):
        values = rng.integers(0, bound, 5_000)
        kinds, at = np.unique(values, return_inverse=True)
        found = P.distinct(values.copy(), bound)
        assert found[0].tolist() == kinds.tolist() and found[1].tolist() == at.tolist()
    keys = rng.integers(0, 1 << P.BITS, 3_000).astype(np.uint64)
    keys = np.concatenate([keys, keys[::-1] ^ np.uint64(1), keys])  # neighbours that differ in the last bit alone
    place, found = P.ascending(keys)
    assert found.tolist() == sorted(keys.tolist()) and keys[place].tolist() == found.tolist()
