import random
import re
from collections import Counter

import numpy as np
import pytest

from tamarack.llm import phrases
from tamarack.llm.phrases import Vocabulary, collocations, extend, split_ids, transform

SCHEMA = "doc_id long, text string, lang string, rank int, f long, number long"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, 1, 2, 3) for k, (lang, t) in enumerate(rows)], SCHEMA)


def brute(rows, least, most_words=5, best=2000):
    fold = {c: c + 32 for c in range(65, 91)}
    n, f = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, most_words + 1) for i in range(len(w) - k + 1))
    f = {g: c for g, c in f.items() if c >= least}
    out = {}
    for (lang, g), a in f.items():
        if len(g) < 2:
            continue
        longer = any(
            h[0] == lang and len(h[1]) > len(g) and c >= a and any(h[1][i : i + len(g)] == g for i in range(len(h[1]))) for h, c in f.items()
        )
        if longer:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]], n[lang]))
    return {(lang, r + 1, p.decode(), -a, l, rr, m, -s) for lang, found in out.items() for r, (s, a, p, l, rr, m) in enumerate(sorted(found)[:best])}


def texts(rng, n, vocabulary, size):
    ends = [". ", ", ", "\n", " ", " ", " ", "\t", "  "]
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(size))]
        if rng.random() < 0.4:
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(["in the light of it", "red hot sun", "One Two"]).split()
        out.append("".join(w + rng.choice(ends) for w in words))
    return out


@pytest.mark.parametrize("shard_words,ranges,most_words", [(2**21, 4096, 5), (150, 4096, 5), (150, 3, 3), (400, 4096, 2)])
def test_equals_brute_force(spark, monkeypatch, shard_words, ranges, most_words):
    """One shard per task, many small shards, counters in ranges of another size, and fewer words."""
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(phrases, "RANGES", ranges)
    monkeypatch.setattr(phrases, "RANGE_COUNTERS", 2**16 if ranges > 3 else 2**10)
    rng = random.Random(shard_words)
    vocabulary = "a b c The the Été été λ x|y 文字 -- it's of of of in light".split()
    rows = [(lang, t) for lang, n in (("en", 120), ("fr", 60), (None, 30), ("und", 30), ("rare", 2)) for t in texts(rng, n, vocabulary, 30)]
    rows += [("en", None), ("en", ""), ("en", " \t"), ("fr", "..,;\n"), ("en", "z " * 300), ("en", "q" * 5000), ("en", "z " * 300)]
    rng.shuffle(rows)
    got = collocations(frame(spark, rows).repartition(6), least=8, most_words=most_words, best=40).collect()
    want = brute(rows, 8, most_words, 40)
    assert len(want) > 30
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_no_frequent_phrase(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, [("en", "one two three"), (None, None)])).count() == 0
    assert collocations(frame(spark, [("en", "one. " * 200)])).count() == 0


def test_words_of_long_texts_are_split_alike(monkeypatch):
    text = " ".join(random.Random(1).choice(["Ab", "c.d", "e", "éé", "long" * 9]) for _ in range(4000)).encode()
    whole, parts = Vocabulary(), Vocabulary()
    want = np.concatenate(list(split_ids([text, text], whole)))
    monkeypatch.setattr(phrases, "SPLIT_BYTES", 50)
    got = np.concatenate(list(split_ids([text, text], parts)))
    assert (want == got).all() and list(whole) == list(parts)


@pytest.mark.parametrize("symbols", [3, 70_000])
def test_steps_keep_both_intervals(symbols):
    """Counts and intervals of right and left steps against counting in the text."""
    rng = np.random.default_rng(symbols)
    text = np.r_[rng.choice([1, 2, symbols], 400) * (rng.random(400) < 0.9), 0].astype(np.int32)
    backward_text = np.r_[text[:-1][::-1], 0].astype(np.int32)
    forward, backward = transform(text, 4), transform(backward_text, 4)
    size = np.bincount(text, minlength=symbols + 1)
    low = np.cumsum(size)[:-1]
    base, symbol, back, fore, count = extend(backward, low, low, size[1:], symbols, False)
    grams = Counter(zip(text.tolist(), text[1:].tolist()))
    pairs = list(zip((base + 1).tolist(), symbol.tolist()))
    assert dict(zip(pairs, count.tolist())) == {g: n for g, n in grams.items() if all(g)}
    order = np.argsort(fore)
    phrase, left, fore3, back3, count3 = extend(forward, fore[order], back[order], count[order], symbols, True)
    triples = Counter(zip(text.tolist(), text[1:].tolist(), text[2:].tolist()))
    got = {(int(s), *pairs[order[p]]): int(n) for p, s, n in zip(phrase, left, count3)}
    assert got == {g: n for g, n in triples.items() if all(g)}
    # the intervals found are those of the phrases among sorted suffixes
    for sorted_text, starts, turn in ((text, fore3, 1), (backward_text, back3, -1)):
        n = len(sorted_text)
        suffixes = sorted(tuple(np.r_[sorted_text[i : i + 3], [0, 0, 0]][:3].tolist()) for i in range(n))
        for p, s, at, c in zip(phrase, left, starts, count3):
            gram = (int(s), *pairs[order[p]])[::turn]
            assert suffixes[at] == gram and suffixes[at + c - 1] == gram
