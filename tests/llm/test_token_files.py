import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import CLASHING, docs
from martforge.llm import token_files
from martforge.llm.queries import WORD_BPE
from martforge.session import scratch_path

TEXTS = [(5, "Hello # world"), (-2, None), (3, ""), (None, "no id"), (9, "x, " * 4000), (3, "same id"), (7, "i̇ İ é́"),
         (8, "<|endoftext|>"), (8, "<|endoftext|>")] + [(50 + i, "the quick brown fox " * (i % 9)) for i in range(60)]


def expected(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def test_files_hold_every_document_in_id_order(spark):
    path = scratch_path(spark, "files")
    token_files.write(docs(spark, TEXTS, CLASHING), path, WORD_BPE, shard_tokens=500)
    got = [tuple(r) for r in token_files.read(spark, path).orderBy("start").collect()]
    ordered = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for (ident, text), row in zip(ordered, got, strict=True):
        ids = expected(text)
        data = np.array(ids, "<u4").tobytes()
        assert row == (ident, start, len(ids), zlib.crc32(data), bytearray(data))
        start += len(ids)
    for shard in spark.read.parquet(path).collect():
        whole = token_files.decode_range(shard, 0, shard["n_tokens"])
        a, b = shard["n_tokens"] // 3, shard["n_tokens"] // 2
        assert (token_files.decode_range(shard, a, b) == whole[a:b]).all()


def test_empty_table(spark):
    path = scratch_path(spark, "files")
    token_files.write(docs(spark, []), path, WORD_BPE)
    assert token_files.read(spark, path).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.integers(1, 8))
def test_round_trip_of_any_ids(ids, rounds):
    ids = np.array(ids, dtype="<u4")
    first, symbols, rules, expansions = token_files.compress(ids, rounds, 2)
    table = token_files.expansion_table(first, rules, expansions)
    assert (token_files.expand(symbols.astype(np.int64), table) == ids).all()
    shard = {"first_symbol": first, "symbols": symbols.tobytes(), "rules": rules.tobytes(), "expansions": expansions.tobytes()}
    for a in range(0, ids.size, 7):
        assert (token_files.decode_range(shard, a, min(a + 5, ids.size)) == ids[a:a + 5]).all()


@pytest.mark.parametrize("unit", [[1], [1, 2], [1, 1, 2], [70_000, 5, 70_000]])
def test_repetitive_ids_shrink(unit):
    ids = np.array(unit * 5000, dtype="<u4")
    first, symbols, rules, expansions = token_files.compress(ids, 12, 2)
    assert symbols.size + 2 * len(rules) < ids.size / 50
    assert (token_files.expand(symbols.astype(np.int64), token_files.expansion_table(first, rules, expansions)) == ids).all()


def test_production_rules_leave_no_frequent_pair():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 49_000, 700)
    mixed = np.concatenate([np.append(rng.integers(0, 300, 40), passage) for _ in range(400)])
    for ids, share in ((np.tile(passage, 600), 100), (np.full(200_000, 7), 1000), (mixed, 10), (rng.integers(0, 90, 50_000), 1)):
        ids = ids.astype("<u4")
        first, symbols, rules, expansions = token_files.compress(ids)
        assert (token_files.expand(symbols.astype(np.int64), token_files.expansion_table(first, rules, expansions)) == ids).all()
        assert symbols.size + 3 * len(rules) < ids.size / share
        # Every second one of a run of equal symbols counts.
        run, counts, last = 0, {}, None
        for pair in zip(symbols[:-1].tolist(), symbols[1:].tolist()):
            run = run + 1 if pair == last else 1
            counts[pair] = counts.get(pair, 0) + run % 2
            last = pair
        assert max(counts.values(), default=0) < token_files.LEAST_COUNT
