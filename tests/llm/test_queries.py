"""Registered queries over whole tables: SQL twins where there are any, else brute force."""

import os
import zlib

import duckdb
import numpy as np
import pytest

from helpers import shingles, smallest_reachable
from martforge.llm import queries

TABLES = ["documents", "embeddings", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(sf, t)}.parquet')")
    return con


def test_one_query_for_each_operator():
    assert [k.split("_")[0] for k in queries.REGISTRY] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.REGISTRY) - set(queries.ORACLE) == {"op1_packing", "op3_token_files", "op7_toxicity", "op8_language_id"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf, duck, name):
    got, want = {**queries.REGISTRY, **queries.SECOND}[name](spark, sf), duck.sql(queries.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]

    def plain(row):
        return tuple(round(v, 6) if isinstance(v, float) else v for v in row)

    assert sorted(map(str, map(plain, got.collect()))) == sorted(str(plain([r[i] for i in order])) for r in want.fetchall())


@pytest.mark.parametrize("name, path, end", [("op1_packing", queries.BYTE_BPE, 0), ("op3_token_files", queries.WORD_BPE, 2)])
def test_token_queries_equal_the_library(spark, sf, duck, name, path, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [end] for i, t in duck.sql("select doc_id, text from documents").fetchall()}
    got = queries.REGISTRY[name](spark, sf).collect()
    if end:
        start = 0
        rows = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got}
        for i in sorted(ids):
            assert rows[i] == (start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes()))
            start += len(ids[i])
        return
    seen = {i: np.zeros(len(x), dtype=int) for i, x in ids.items()}
    for r in got:
        part = slice(r["start"], r["start"] + r["length"])
        seen[r["doc_id"]][part] += 1
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["doc_id"]][part], "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert all((s == 1).all() for s in seen.values())


def test_classifiers_on_held_out_rows(spark, duck):
    sf = "/root/testdata/sf0.1"
    lang = dict(duck.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    toxic = dict(duck.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    found = [r for r in queries.op8_language_id(spark, sf).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in found)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in found]) > 0.97
    scored = [r for r in queries.op7_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in toxic]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in scored)
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in scored]) > 0.93


def test_the_pipeline_equals_its_stages_by_brute_force(spark, sf, duck):
    import re

    import corpus_pipeline

    docs = duck.sql("select doc_id, text, lang, source, n_chars from documents order by doc_id").fetchall()
    kept = {}
    for row in docs:
        if row[1] and re.search(r"[^\W\d_]", row[1]):
            kept.setdefault(re.sub(r"[\x20\x09-\x0D]", "", row[1]), []).append(row)
    stay = [min(g, key=lambda r: (-len(r[1]), r[0])) for g in kept.values()]
    sets = {r[0]: shingles(r[1], 5) for r in stay}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = smallest_reachable(ids, links)
    left = [r for r in stay if found[r[0]] == r[0]]
    frame = spark.createDataFrame(left, "doc_id long, text string, lang string, source string, n_chars long")
    want = corpus_pipeline.packed(spark, corpus_pipeline.mixed(spark, frame, sf), sf)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def pieces(df):
        return sorted(tuple(r[k] for k in key) for r in df.collect())

    got = corpus_pipeline.run(spark, sf)
    assert pieces(got) == pieces(want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
