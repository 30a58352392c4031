import hashlib
import random
from collections import Counter

import pytest
from helpers import CLASHING, docs
from hypothesis import given, settings
from hypothesis import strategies as st
from martforge.llm import line_dedup, queries


def brute(table):
    """Lines that stand with a neighbour earlier in the table go, unless the pair overlaps its own first occurrence."""
    first, out = {}, []
    for at, (_, text) in enumerate(table):
        lines, gone = (text or "").split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            where = first.setdefault(pair, (at, i))
            if where[0] < at or where[1] + 1 < i:
                gone |= {i, i + 1}
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def left(spark, table, **how):
    """Texts that remain, in the order of the table."""
    got = line_dedup.clean(docs(spark, table, CLASHING), **how).collect()
    for r in got:
        text = r["row"]["text"]
        assert r["n_lines"] == (text.count("\n") + 1 if text is not None else 0)
        assert (r["text"] or "").count("\n") + 1 >= r["n_lines"] - r["removed_lines"] >= 0
        assert (r["text"] is None) == (text is None)
    texts = {r["row"]["doc_id"]: r["text"] or "" for r in got}
    return [texts[i] for i, _ in table]


def chunks(text):
    lines, at, out = text.split(b"\n"), 0, []
    for n in line_dedup.chunk_sizes(lines):
        out.append(lines[at:at + n])
        at += n
    return out


def chunks_alone(table):
    """Lines that go by chunks alone, of each document."""
    first, out = {}, {}
    for i, text in table:
        out[i] = 0
        for nth, c in enumerate(chunks(text.encode()) if text is not None else []):
            if len(c) >= 2 and first.setdefault(tuple(c), (i, nth)) != (i, nth):
                out[i] += len(c)
    return out


def texts(seed):
    rng = random.Random(seed)
    passage = [f"shared line {i} of a passage" for i in range(24)]
    out = []
    for i in range(80):
        own = [f"own {seed} {i} {rng.random()}" for _ in range(rng.randint(0, 9))]
        at = rng.randint(0, len(own))
        out.append("\n".join(own[:at] + (passage if i % 3 else []) + own[at:]))
    return out


def test_passages_equal_brute_force(spark):
    rng = random.Random(3)
    table = [(-1, "same\n" * 40), *enumerate(texts(1)), (500, None), (501, ""), (502, "\n\n\n"), (503, "a\r\nb\r\n"), (504, "\n" * 50),
             (505, "same\n" * 40)]
    table += [(600 + i, "\n".join(rng.choice(["", "a", "b", "c d"]) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    assert left(spark, table) == brute(table)


def test_chunks_find_most_of_a_long_passage():
    # Boundaries meet again a few lines into the shared passage, wherever it begins.
    gone = chunks_alone(list(enumerate(texts(1))))
    assert Counter(gone[i] > 8 for i in range(80) if i % 3)[True] >= 50


def test_pairs_are_compared_only_outside_known_chunks():
    marks = [b"a", b"b", b"c", b"d", b"e"]
    assert [(at, part) for at, _, part in line_dedup.pair_parts(marks, [], [{"at": 1, "n": 3}])] == [(0, b"ab"), (3, b"de")]
    assert len(list(line_dedup.pair_parts(marks, [], []))) == 4 and not list(line_dedup.pair_parts([b"a"], [], []))


def test_repeated_rows_null_ids_and_long_texts(spark):
    long = "\n".join(f"line {i}" for i in range(20_000))
    table = [(1, long), (2, long), (2, long), (None, long), (None, "alone\nhere")]
    got = sorted((r["row"]["doc_id"] or 0, r["n_lines"] - r["removed_lines"]) for r in line_dedup.clean(docs(spark, table)).collect())
    left = [n for _, n in got]
    assert got[2:] and left[2] == 20_000 and len(got) == 5
    assert all(n < 10_000 for i, n in got if i == 2)


def test_empty_table(spark):
    assert line_dedup.clean(docs(spark, [])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["", "a", "b", "c d"]), min_size=1, max_size=60))
def test_chunks_hold_the_text(lines):
    text = "\n".join(lines).encode()
    assert b"\n".join(x for c in chunks(text) for x in c) == text


def test_short_passages_go_at_any_offset(spark):
    table, own = [], []
    for n in range(2, 7):
        passage = [f"passage of {n}, line {k}" for k in range(n)]
        table.append((len(table), "\n".join(["first", str(n), *passage])))
        own.append(table[-1][1])
        for before in range(6):
            mine = [f"own {n} {before} {k}" for k in range(before + 3)]
            table.append((len(table), "\n".join(mine[:before] + passage + mine[before:])))
            own.append("\n".join(mine))
    assert left(spark, table) == own == brute(table)


def test_passages_of_repeated_rows_and_null_ids(spark):
    table = [(1, "a\nb"), (2, "c\nd"), (2, "c\nd"), (2, "x\ny\nz"), (None, "a\nb"), (None, "alone\nhere")]
    got = sorted((r["row"]["doc_id"] or 9, r["text"]) for r in line_dedup.clean(docs(spark, table)).collect())
    assert got == [(1, "a\nb"), (2, "c\nd"), (2, "c\nd"), (2, "x\ny\nz"), (9, ""), (9, "alone\nhere")]


def test_query_equals_brute_force(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = {r["doc_id"]: r for r in queries.op6_line_dedup(spark, sf).collect()}
    for (ident, text), rest in zip(table, brute(table), strict=True):
        want = (None, None) if text is None else (len(rest), hashlib.sha256(rest.encode()).hexdigest())
        assert (got[ident]["chars_left"], got[ident]["text_sha256"]) == want
    # All that goes by chunks goes, and more.
    assert all(got[i]["removed_lines"] >= n for i, n in chunks_alone(table).items())


@pytest.mark.parametrize("weak", [lambda x: b"", lambda x: x[-1:]])
def test_colliding_digests_give_way_to_contents(spark, weak):
    table = list(enumerate(texts(2)))
    assert left(spark, table, digest=weak) == brute(table)


def test_a_line_pair_on_a_third_of_the_rows(spark):
    table = [(i, f"own {i}\nof\nmine {i}" if i % 3 else f"own {i}\nlicensed under\nthe same terms\nlast {i}") for i in range(600)]
    assert left(spark, table) == brute(table)
