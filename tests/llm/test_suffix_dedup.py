import random
from collections import Counter

import numpy as np
import pytest

from helpers import CLASHING, DOCS, docs, vocabulary
from martforge.llm import suffix_dedup


def plain(rows, width=200):
    """(id, bytes, removed, spans, kept) of each row, from all windows."""
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(t[k:k + width] for _, t in data for k in range(len(t) - width + 1))
    out = []
    for i, t in data:
        gone = np.zeros(len(t) + 2, dtype=bool)
        for k in range(len(t) - width + 1):
            if seen[t[k:k + width]] > 1:
                gone[k + 1:k + 1 + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone[1:-1]) if not g)))
    return sorted(out, key=str)


def found(spark, rows, schema=DOCS, **more):
    return sorted(((r["row"]["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"]))
                   for r in suffix_dedup.clean(docs(spark, rows, schema), **more).collect()), key=str)


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(seed, n=40):
    """Texts with shared passages at any offset, near and exact copies, periodic runs and short texts."""
    rng, words = random.Random(seed), vocabulary(300, seed) + ["größe", "日本語", "é"]
    passages = [prose(rng, words, k) for k in (30, 45, 60, 90, 200)]
    out = []
    for i in range(n):
        text = prose(rng, words, rng.randint(0, 120))
        if i % 2:
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            text = prose(rng, words, rng.randint(0, 40)) + p[a:len(p) - rng.randint(0, len(p) // 3)] + text
        out.append((i, text))
    own = list(out[3][1])
    own[len(own) // 2] = "#"
    return out + [(100, out[3][1]), (101, "".join(own)), (102, "ab" * 300), (103, "x" * 900), (104, "line of text\n" * 40), (105, "x" * 199)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("hot, bucket", [(1, 1), (2, 5), (6, 1000)])
def test_frequent_grams_are_split_without_loss(spark, hot, bucket):
    rng, words = random.Random(9), vocabulary(300, 9)
    common = prose(rng, words, 60)
    rows = corpus(4, 12) + [(200 + i, prose(rng, words, 30) + common + prose(rng, words, 30)) for i in range(12)]
    assert found(spark, rows, hot=hot, bucket=bucket) == plain(rows)


def test_other_widths(spark):
    rows = corpus(5, 20)
    assert found(spark, rows, width=40, gram=16) == plain(rows, 40)
    assert found(spark, rows, width=16, gram=16) == plain(rows, 16)
    with pytest.raises(ValueError):
        suffix_dedup.clean(docs(spark, rows), gram=48)


def test_defined_cases(spark):
    long = prose(random.Random(1), vocabulary(200, 1), 80)
    rows = [(1, None), (2, ""), (3, long), (3, long), (3, long[:300] + "?" + long[300:]), (None, long[50:]), (None, long[:260]),
            (4, "short"), (4, "short"), (5, "\x00" * 450), (6, "z" + "\x00" * 210), (7, "w" * 50_000 + long)]
    assert found(spark, rows, CLASHING) == plain(rows)
    assert found(spark, []) == []


def test_equal_windows_name_the_same_anchor():
    rng = np.random.default_rng(2)
    a = rng.integers(97, 101, 3000).astype(np.uint8)
    b = np.concatenate([rng.integers(97, 101, 77).astype(np.uint8), a[500:1500]])
    of = {}
    for name, text in (("a", a), ("b", b)):
        h, at, first, last = suffix_dedup.anchors(text)
        assert first[0] == 0 and last[-1] == len(text) - 200 and (first[1:] == last[:-1] + 1).all()
        of[name] = {int(w): (int(x), int(p) - int(w)) for x, p, f, z in zip(h, at, first, last) for w in range(f, z + 1)}
    assert all(of["a"][500 + k] == of["b"][77 + k] for k in range(801))


def test_common_prefixes_are_those_of_the_sorted_columns():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 3, (12, 40)).astype(np.uint16)
    for t, order, common in suffix_dedup.common_prefixes(symbols):
        suffix = [tuple(symbols[t:, i].tolist()) for i in order]
        assert suffix == sorted(suffix)
        for k in range(1, len(suffix)):
            same = next((j for j, (x, y) in enumerate(zip(suffix[k - 1], suffix[k])) if x != y), len(suffix[k]))
            assert common[k] == same
