import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import CLASHING, docs
from martforge.llm import packing
from martforge.llm.queries import BYTE_BPE

TEXTS = [(1, "hello world, it's fine"), (2, None), (3, ""), (4, "word " * 3000), (5, "a"), (5, "a"), (None, "é́  x \U0001f600"),
         (6, "<|endoftext|>"), (7, "tab\t\n\n  end ")] + [(100 + i, "some words " * (i % 97)) for i in range(150)]


def expected_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_cover_each_document_once_and_sequences_are_gapless(spark):
    table = docs(spark, TEXTS, CLASHING)
    cut = packing.pieces(table, BYTE_BPE)
    placed = packing.pack(cut).collect()
    by_doc, by_sequence = {}, {}
    for r in placed:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for ident, text in TEXTS:
        ids = expected_ids(text)
        want = [(a, len(ids[a:a + 1024]), zlib.crc32(np.array(ids[a:a + 1024], "<u4").tobytes()), len(ids)) for a in range(0, len(ids), 1024)]
        assert sorted(set(by_doc[ident])) == want
    assert len(by_doc[5]) == 2
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in placed)
    assert len(by_sequence) == -(-total // 1024)  # no packing has fewer sequences
    whole = packing.sequences(cut, packing.pack(cut)).collect()
    assert sum(r["length"] for r in whole) == total and all(len(r["ids"]) == 4 * r["length"] for r in whole)


def test_empty_table(spark):
    assert packing.packed(docs(spark, []), BYTE_BPE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_patterns_place_the_whole_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    placed = {}
    for count, pattern in patterns:
        assert count > 0 and 0 < sum(pattern) <= 64
        for length in pattern:
            placed[length] = placed.get(length, 0) + count
    assert placed == histogram
    table = packing.slots(patterns)
    assert len({tuple(r[:2]) for r in table.tolist()}) == len(table)


def test_packing_is_tight_and_independent_of_scale():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(np.clip(rng.lognormal(5.5, 1, 20_000).astype(int), 1, 1024), return_counts=True)
    for scale in (1, 1000):
        histogram = dict(zip(lengths.tolist(), (counts * scale).tolist()))
        patterns = packing.shortest_pack_first(histogram)
        tokens = sum(k * v for k, v in histogram.items())
        assert sum(c for c, _ in patterns) * 1024 < tokens * 1.001
        assert len(patterns) < 5000


def test_an_encoder_keeps_as_many_pieces_as_asked_for():
    from martforge.llm.encoding import Encoder
    from martforge.llm.queries import BYTE_BPE

    texts = [f" word{chr(97 + i % 26)}{chr(97 + i // 26)} x" for i in range(600)] * 2
    small, large = Encoder(BYTE_BPE, 100), Encoder(BYTE_BPE)
    assert [small([t]) for t in texts] == [large([t]) for t in texts]
    assert len(small.memo) + len(small.memo.older) < 110 < len(large.memo) and small.memo.older.older == {}
