"""One query per operator on the whole documents table. Each derives its columns from the operator's results."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from .alignment import alignment_table
from .common import documents
from .decontaminate import find_leaks
from .exact import group_table
from .jaccard import component_table
from .langid import identify
from .licenses import license_table
from .mixing import with_repeats
from .negatives import hard_negatives
from .packing import pack
from .pii import entity_table
from .registry import query
from .repeats import repeated_passages
from .sharding import shard_table
from .tokens import tokenize_documents

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_language")
def op1(spark, sf_dir):
    return identify(documents(spark, sf_dir))


@query("op2_licenses")
def op2(spark, sf_dir):
    return license_table(documents(spark, sf_dir))


@query("op3_tokens")
def op3(spark, sf_dir):
    return tokenize_documents(documents(spark, sf_dir), tokenizer_file())


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query("op4_jaccard", f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(words) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(words) - 3),
                 lambda i: array_to_string(words[i:i + 4], ' ')))) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS found FROM w),
    c AS (SELECT min(doc_id) AS first, found FROM s WHERE len(found) > 0 GROUP BY found),
    e AS (SELECT first, len(found) AS n, unnest(found) AS shingle FROM c),
    p AS (SELECT a.first AS x, b.first AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS met
          FROM e a JOIN e b ON a.shingle = b.shingle AND a.first < b.first GROUP BY 1, 2),
    k AS (SELECT x, y FROM p WHERE 100 * met >= 80 * (nx + ny - met)),
    l AS (SELECT x, y FROM k UNION ALL SELECT y, x FROM k),
    r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
    m AS (SELECT x, min(y) AS least FROM r GROUP BY x)
    SELECT s.doc_id, len(s.found)::BIGINT AS n_shingles, coalesce(least(c.first, m.least), c.first, s.doc_id) AS component_id
    FROM s LEFT JOIN c ON s.found = c.found LEFT JOIN m ON m.x = c.first""")
def op4(spark, sf_dir):
    return component_table(documents(spark, sf_dir).select("doc_id", "text"))


@query("op5_exact_dedup", f"""
    WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256, {_LOWER} AS content FROM documents),
    g AS (SELECT *, max(doc_id) OVER (PARTITION BY content) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""")
def op5(spark, sf_dir):
    return group_table(documents(spark, sf_dir))


@query("op6_sharding")
def op6(spark, sf_dir):
    rows = shard_table(documents(spark, sf_dir), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query("op10_mixing", r"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
        FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
                 source_size * 3.0::DOUBLE AS cap, (SELECT sum(source_size) FROM s)::DOUBLE AS total FROM s),
    c AS (SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                 < (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS clamped FROM w),
    t AS (SELECT source, source_size, CASE WHEN clamped THEN cap ELSE
                 (total - coalesce((SELECT sum(cap) FROM c WHERE clamped), 0)) * weight
                 / (SELECT sum(weight) FROM c WHERE NOT clamped) END AS target FROM c),
    r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
    m AS (SELECT *, target - whole * source_size AS missing FROM r),
    p AS (SELECT source, place, sum(size) AS filled FROM d GROUP BY source, place),
    q AS (SELECT *, coalesce(sum(filled) OVER (PARTITION BY source ORDER BY place
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM p)
    SELECT d.doc_id, d.size, m.source_size, m.target,
           d.size * (m.whole + CASE WHEN q.ahead + q.filled / 2 <= m.missing THEN 1 ELSE 0 END) AS taken
    FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source
    JOIN q ON d.source IS NOT DISTINCT FROM q.source AND d.place = q.place""")
def op10(spark, sf_dir):
    rows, at = with_repeats(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return rows.select("doc_id", at["size"], at["source_size"], at["target"], (F.col(at["size"]) * F.col(at["repeats"])).alias("taken"))


@query("op7_pii")
def op7(spark, sf_dir):
    return entity_table(documents(spark, sf_dir))


@query("op8_decontaminate")
def op8(spark, sf_dir):
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op9_repeats")
def op9(spark, sf_dir):
    return repeated_passages(documents(spark, sf_dir))


_ANCHOR_EVERY, _RELABEL_EVERY, _LABELS = 50, 7, 10


@query("op11_negatives", f"""
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % {_RELABEL_EVERY} = 0 THEN (label + 1) % {_LABELS} ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS r
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
    a AS (SELECT * FROM v WHERE vec_id % {_ANCHOR_EVERY} = 0),
    s AS (SELECT a.r AS a_r, a.vec_id AS anchor_id, a.label = v.label AS same, v.r, v.vec_id,
                 list_inner_product(a.q, v.q)::BIGINT AS score
          FROM a JOIN v ON a.label <> v.label OR a.vec_id IS DISTINCT FROM v.vec_id),
    p AS (SELECT *, row_number() OVER (PARTITION BY a_r ORDER BY score DESC, vec_id, r) AS n FROM s WHERE same),
    m AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.a_r, p.n ORDER BY s.score DESC, s.vec_id) AS rank
          FROM p JOIN s ON p.a_r = s.a_r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
          WHERE p.n <= 5)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 3""")
def op11(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % _RELABEL_EVERY == 0, (F.col("label") + 1) % _LABELS).otherwise(F.col("label"))
    items = rows.select(F.col("vec_id").alias("id"), moved.alias("label"), (F.col("vec_id") % _ANCHOR_EVERY == 0).alias("is_anchor"), F.col("embedding").alias("vector"))
    return hard_negatives(items)


@query("op12_alignment")
def op12(spark, sf_dir):
    return alignment_table(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query("op13_packing")
def op13(spark, sf_dir):
    return pack(documents(spark, sf_dir), tokenizer_file(), with_ids=False)
