"""Small tables for the operator tests, and brute-force forms of what the operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside, as extra input columns.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, digest string, id long, " \
           "component_id long, kept boolean, copies long, score double, nth long, part int, __text string"


def docs(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def vocabulary(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def near_texts(seed, families=6, size=30, length=60, edits=8):
    """Families of texts with 0 to ``edits`` words changed, beside unrelated ones."""
    rng, words = random.Random(seed), vocabulary(400, seed)
    out = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(length + rng.randint(0, 40))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    out += ["", "   ", "one", "one two", "ONE two", None, out[0], out[0].upper(), out[1] + "\n"]
    return out


def shingles(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def smallest_reachable(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}
