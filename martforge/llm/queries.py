"""The registered query of each operator over its whole table, with production parameters, and SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import (
    centroids,
    chat_format,
    divergence,
    embedding_dedup,
    exact_dedup,
    language_id,
    line_dedup,
    minhash,
    mixing,
    packing,
    suffix_dedup,
    token_files,
    toxicity,
)
from martforge.llm.common import table
from martforge.session import scratch_path

#: Tokenizer files are a parameter; these are the contracts'.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allocations(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    token_files.write(table(spark, sf_dir, "documents"), path, WORD_BPE)
    return token_files.read(spark, path, ids=False)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents")).drop("digest")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.members(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.clean(table(spark, sf_dir, "documents"), keep=F.col("doc_id"))
    return done.select(F.col("row").alias("doc_id"), "n_lines", "removed_lines",
                       F.length("text").cast("bigint").alias("chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language_id.fold(F.col("doc_id"), 5) == 0
    # Texts held out cannot be learned from, so they need not be moved to the labels.
    model = toxicity.fit(docs.filter(~held_out), labels.filter(~held_out))
    return toxicity.score(docs, model, keep=[F.col("doc_id"), held_out.alias("held_out")])


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.fold(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.filter(~held_out))
    return language_id.detect(docs, model, keep=[F.col("doc_id"), held_out.alias("held_out")])


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.groups(table(spark, sf_dir, "embeddings"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("""
        SELECT -1L AS conv_id, n AS turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(n, role)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    output = chat_format.render(chat_format.from_rows(rows))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat_format.read_back(output).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.clean(table(spark, sf_dir, "documents"), keep=F.col("doc_id"))
    return done.select(F.col("row").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_token_files": op3_token_files,
    "op4_minhash": op4_minhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_divergence": op12_divergence,
    "op13_centroids": op13_centroids,
}

#: Earlier names of queries, kept.
SECOND: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op6_passages": op6_line_dedup,
}


def _centroid_rounds(rounds: int = 10) -> str:
    """The rounds of clustering one after the other, each as two tables: assignments, then centroids by component."""
    near = """a{r} AS MATERIALIZED (
    SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT k.rid, c.c, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT AS d
        FROM kept k, c{r} c) GROUP BY rid)"""
    move = """c{n} AS MATERIALIZED (
    SELECT c, coalesce(any_value(m.v), any_value(c{r}.v)) AS v FROM c{r} LEFT JOIN (
        SELECT c, list(s ORDER BY i) AS v FROM (
            SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS s
            FROM (SELECT a{r}.c, unnest(range(1, 65)) AS i, unnest(v)::HUGEINT AS x FROM a{r} JOIN kept USING (rid)) GROUP BY c, i)
        GROUP BY c) m USING (c) GROUP BY c)"""
    steps = [part for r in range(rounds) for part in (near.format(r=r), move.format(r=r, n=r + 1))]
    return """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), v) - 1 AS c, v FROM kept
    QUALIFY c < 8
), """ + ",\n".join([*steps, near.format(r=rounds)]) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (rid) JOIN c{rounds} c ON c.c = a.c"""


ORACLE: dict[str, str] = {
    "op2_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), per AS (
    SELECT source, sum(size)::HUGEINT AS words, row_number() OVER (ORDER BY source NULLS LAST) AS nth
    FROM sized GROUP BY source
), weighted AS (
    SELECT source, words, 3 * words AS cap, CASE (nth - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS w FROM per
), levels AS (
    -- One candidate water level per source: everything at or below it in cap / weight is full.
    SELECT sum(CASE WHEN x.cap * y.w <= y.cap * x.w THEN x.cap ELSE 0 END) AS filled,
           sum(CASE WHEN x.cap * y.w <= y.cap * x.w THEN 0 ELSE x.w END) AS open_w
    FROM weighted x, weighted y GROUP BY y.source, y.cap, y.w
    UNION ALL SELECT 0, sum(w) FROM weighted
), fits AS (
    -- The level that holds: the open sources take no more than their caps, and the full ones would.
    SELECT filled, open_w FROM levels, (SELECT sum(words) AS total FROM weighted)
    WHERE open_w > 0 AND NOT EXISTS (
        SELECT 1 FROM weighted z
        WHERE (z.w * (total - filled) > z.cap * open_w)
              <> (z.cap * 1.0 / z.w <= coalesce((SELECT max(v.cap * 1.0 / v.w) FROM weighted v
                    WHERE v.w * (total - filled) > v.cap * open_w), -1)))
      AND (SELECT coalesce(sum(v.cap), 0) FROM weighted v WHERE v.w * (total - filled) > v.cap * open_w) = filled
    LIMIT 1
), target AS (
    SELECT source, words, CASE WHEN w * (total - filled) > cap * open_w THEN cap::DOUBLE
                               ELSE (w * (total - filled))::DOUBLE / open_w::DOUBLE END AS target
    FROM weighted, fits, (SELECT sum(words) AS total FROM weighted)
), placed AS (
    SELECT doc_id, size, words::BIGINT AS source_size, target, CASE WHEN words > 0 THEN target / words::DOUBLE ELSE 0 END AS rate,
           row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id)::DOUBLE AS k,
           ('0x' || substr(md5('20240917|' || (s.source IS NULL)::VARCHAR || '|' || coalesce(s.source, '')), 1, 4))::INTEGER / 65536.0::DOUBLE AS u
    FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(k * rate + u) - floor((k - 1) * rate + u), ceil(rate)) * size)::BIGINT AS taken
FROM placed""",
    "op4_minhash": r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM tokens WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), linked AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
    JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
    WHERE 100 * shared >= 80 * (sa.n + sb.n - shared)
), reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reach.doc_id, linked.b FROM reach JOIN linked ON linked.a = reach.r
)
SELECT reach.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(r) AS component_id, reach.doc_id = min(r) AS kept
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id GROUP BY reach.doc_id""",
    "op5_exact_dedup": r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
), grouped AS (
    SELECT doc_id, content, first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size
    FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM grouped""",
    "op6_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents
), pair AS (
    SELECT doc_id, i, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS content FROM lines
), again AS (
    -- Pairs that stand earlier, and share no line with that place.
    SELECT doc_id, i FROM (
        SELECT doc_id, i, first_value(doc_id) OVER w AS first_doc, first_value(i) OVER w AS first_i
        FROM pair WHERE content IS NOT NULL WINDOW w AS (PARTITION BY content ORDER BY doc_id, i))
    WHERE first_doc < doc_id OR first_i + 2 <= i
), gone AS (
    SELECT doc_id, i FROM again UNION SELECT doc_id, i + 1 FROM again
), cleaned AS (
    SELECT doc_id, count(*) AS n_lines, count(gone.i) AS removed_lines,
           coalesce(string_agg(line, chr(10) ORDER BY lines.i) FILTER (gone.i IS NULL), '') AS rest
    FROM lines LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(removed_lines, 0) AS removed_lines,
       CASE WHEN d.text IS NOT NULL THEN length(rest) END AS chars_left,
       CASE WHEN d.text IS NOT NULL THEN sha256(rest) END AS text_sha256
FROM documents d LEFT JOIN cleaned USING (doc_id)""",
    "op9_embedding_dedup": r"""
WITH RECURSIVE fit AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM fit x JOIN fit y
      ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
    WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v)) / sqrt(list_dot_product(y.v, y.v)) >= 0.98
), reach(vec_id, r) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT reach.vec_id, linked.b FROM reach JOIN linked ON linked.a = reach.r
)
SELECT vec_id, (SELECT count(*) FROM linked WHERE a = vec_id) AS n_links, min(r) AS component_id, vec_id = min(r) AS kept
FROM reach GROUP BY vec_id""",
    "op10_chat_format": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length(role) + length(text) + 32
              + len(regexp_extract_all(role, '[<\[]\\*(?:\||/?s>|</?SYS>>|/?INST\])'))
              + len(regexp_extract_all(text, '[<\[]\\*(?:\||/?s>|</?SYS>>|/?INST\])')) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op11_suffix_dedup": r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), blocks AS (
    -- Cut by 256 bytes, each with the 199 that follow, so that a window is found near the start of a short string.
    SELECT rid, b, substr(h, 2 * b + 1, 2 * (256 + 199)) AS part
    FROM (SELECT rid, h, unnest(range(0, len(h) // 2, 256)) AS b FROM d)
), windows AS (
    SELECT rid, b + i AS i, substr(part, 2 * i + 1, 400) AS w
    FROM (SELECT rid, b, part, unnest(range(0, least(256, len(part) // 2 - 199))) AS i FROM blocks)
), again AS (
    SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS gap
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY md5(w)) AS n FROM windows) WHERE n > 1
), spans AS (
    SELECT rid, min(i) AS a, max(i) + 200 AS z
    FROM (SELECT *, sum((coalesce(gap, 201) > 200)::INT) OVER (PARTITION BY rid ORDER BY i) AS k FROM again) GROUP BY rid, k
), pieces AS (
    SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS after FROM spans
), removed AS (
    SELECT rid, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS z,
           string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS head
    FROM pieces JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN removed USING (rid)""",
    "op12_divergence": r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), tokens AS (
    SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
    SELECT lang, term, count(*)::HUGEINT AS all_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), held AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(all_n)::HUGEINT AS all_n FROM kept GROUP BY lang
), groups AS (
    SELECT lang, source, coalesce(any_value(s.n), 0) AS size FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS n FROM held GROUP BY ALL) s USING (lang, source) GROUP BY lang, source
), p AS MATERIALIZED (
    SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (size + v) AS p,
           1 + 1000000000::HUGEINT * (kept.all_n + 1) // (langs.all_n + v) AS q
    FROM groups JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN held USING (lang, source, term)
), pairs AS (
    SELECT g.lang, g.source, o.source AS item, coalesce(any_value(x.value), 0) AS value
    FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::HUGEINT AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
      ON x.lang = g.lang AND x.source = g.source AND x.item = o.source
    GROUP BY ALL
), parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT lang, source, part, item, value::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
WHERE part = 'pair' OR rank <= 200""",
    "op13_centroids": _centroid_rounds(),
}
ORACLE["op6_passages"] = ORACLE["op6_line_dedup"]
