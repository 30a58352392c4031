import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import CLASHING, DOCS, docs, vocabulary
from martforge.llm import divergence

LETTER = lambda ch: ch.isascii() and ch.isalpha() or ord(ch) >= 0x80


def terms(text):
    out, run = [], ""
    for ch in (text or "") + " ":
        if LETTER(ch):
            run += ch.lower() if ch.isascii() else ch
        elif run:
            out.append(run)
            run = ""
    return out


def plain(rows, least_docs=3, ranks=200):
    """The contract term by term."""
    group, in_docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        group[lang, source].update(terms(text))
        in_docs[lang].update(set(terms(text)))
    out = []
    for lang, of in sources.items():
        kept = sorted(t for t, d in in_docs[lang].items() if d >= least_docs)

        def probabilities(counts):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // size for t in kept}

        whole = probabilities(sum((group[lang, s] for s in of), Counter()))
        p = {s: probabilities(group[lang, s]) for s in of}

        def part(name, source, values, most=None):
            ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most]
            out.extend((lang, source, name, item, value, n) for n, (item, value) in enumerate(ranked, 1))

        for s in of:
            part("pair", s, [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in of if o != s])
            part("term", s, [(t, (p[s][t] - whole[t]) ** 2 // whole[t]) for t in kept
                             if group[lang, s][t] > 0 and p[s][t] > whole[t]], ranks)
    return sorted(out)


def corpus(seed, n=120):
    rng, words = random.Random(seed), vocabulary(150, seed) + ["Straße", "ÉCOLE", "日本", "naïve"]
    out = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", None])
        own = words[: 40 + 30 * "abc".index(source or "c")]
        text = rng.choice([" ", "-", "\n", "3"]).join(rng.choice(own).upper() if rng.random() < 0.1 else rng.choice(own)
                                                     for _ in range(rng.randint(0, 60)))
        out.append((i, text, rng.choice(["x", "x", "y", None]), source, 0))
    return out


def found(spark, rows, schema=DOCS, **more):
    return sorted(tuple(r) for r in divergence.audit(docs(spark, rows, schema), **more).collect())


def test_equals_the_contract_term_by_term(spark):
    rows = corpus(1)
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, least_docs=1, ranks=5) == plain(rows, 1, 5)


def test_defined_cases(spark):
    rows = [(1, None, "x", "a", 0), (2, "", "x", "b", 0), (3, "123 _", None, None, 0), (4, "one two", "x", "c", 0),
            (4, "one two", "x", "c", 0), (4, "One TWO", "x", "c", 0), (5, "q" * 100_000, "z", "a", 0), (6, "w", "z", "b", 0)]
    got = found(spark, rows, CLASHING)
    assert got == plain(rows)
    assert ("z", "a", "pair", "b", 0, 1) in got  # no kept term: priced 0
    assert not [r for r in got if r[0] == ""]  # one source: no pair, no term
    assert found(spark, []) == []


def test_one_source_with_a_third_of_the_rows_and_equal_sources(spark):
    rows = corpus(2, 60) + [(1000 + i, "same words here again", "x", f"s{i % 4}", 0) for i in range(24)]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("columns", [1, 3, 1000])
def test_block_products_count_joint_levels(columns):
    rng = np.random.default_rng(3)
    held = [[(s, int(n)) for s, n in zip("abc", rng.integers(0, 4, 3)) if n] for _ in range(50)]
    known = sorted({e for h in held for e in h}, key=lambda e: (e[1], e[0]))  # numbers in another order than columns
    rows, cols = zip(*[(i, known.index(e)) for i, h in enumerate(held) for e in h])
    got = Counter()
    for code, count in divergence.products(np.array(rows), np.array(cols), known, columns):
        for c, k in zip(code.tolist(), count.tolist()):
            got[known[c >> 32], known[c & 0xFFFFFFFF]] += int(k)
    assert got == Counter((a, b) for h in held for a in h for b in h if a <= b)


def test_tables_are_the_same_in_small_blocks(spark):
    kept = divergence.kept_terms(divergence.tally(docs(spark, corpus(4)), "text", "lang", "source"))
    whole = sorted(tuple(r) for r in divergence.joint_tables(kept).collect())
    assert whole == sorted(tuple(r) for r in divergence.joint_tables(kept, block=7, columns=5).collect())


def test_flushed_cells_and_terms_add_up(spark, monkeypatch):
    rows = corpus(5)
    monkeypatch.setattr(divergence, "HELD_CELLS", 50)
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    assert found(spark, rows) == plain(rows)
