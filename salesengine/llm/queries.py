"""Registered queries of the operators: thin readings of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, codes, fingerprints, langid, mixing, packing, quality, simhash, substrings, template, trie, warc
from .tables import shared_dir, split_of, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d*)>", 1).try_cast("long")
    read = warc.read_warc(spark, path)
    response = read.where("type = 'response'").select(number(F.col("id")).alias("page_id"), "payload_bytes", "payload_digest",
                                                      F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    sizes = response.groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisit = read.where("type = 'revisit'").select(number(F.col("id")).alias("page_id"), F.regexp_replace("stated_digest", "^sha1:", "").alias("payload_digest"),
                                                    F.col("type").alias("record_type"), number(F.col("refers_to")).alias("refers_to"))
    return response.unionByName(revisit.join(sizes, "payload_digest"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = split_of("doc_id", 4, 2)
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs)).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digest(chat.format_chat(turns.union(probe)))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.score(docs, split_of("doc_id", 7, 2)).withColumnRenamed("id", "doc_id")


def op7_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = str(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, vocabulary, with_ids=False).withColumnRenamed("id", "doc_id")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return template.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(packing.word_counts(table(spark, sf_dir, "documents")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(trie.paths(table(spark, sf_dir, "conversations"))))


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, with_text=False).withColumnRenamed("id", "doc_id")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(*codes.compress(table(spark, sf_dir, "embeddings"))).withColumnRenamed("id", "vec_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_warc, op3_language_id, op4_quality_rules, op5_chat_formatting,
                            op6_lm_scoring, op7_bpe, op8_html_extraction, op9_best_fit, op10_simhash, op11_trie, op12_substrings, op13_vector_codes, pipeline)
}
_CONTROLS = r"(\\|<s>|</s>|\[INST\]|\[/INST\]|<\|image\|>|<\|audio\|>|<\|document\|>)"


def _vector_codes_sql() -> str:
    """The seven assignments of op13 as one CTE each over unnested parts."""
    nearest = """a{r} AS (SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
            SELECT x.r, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN b{r} b USING (p, j) GROUP BY ALL) GROUP BY ALL)"""
    means = """b{n} AS (SELECT b.p, b.e, b.j, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
            SELECT x.p, a.e, x.j, (sum(x.v) - (sum(x.v) % count(*) + count(*)) % count(*)) // count(*) AS v
            FROM x JOIN a{r} a USING (r, p) GROUP BY ALL) m USING (p, e, j))"""
    rounds = [nearest.format(r=r) + ",\n        " + means.format(r=r, n=r + 1) for r in range(codes.ROUNDS)]
    return f"""
        WITH k AS (SELECT vec_id, label, embedding AS v, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        f AS (SELECT r, unnest(v)::DOUBLE AS c, unnest(range(len(v))) AS i, len(v) // {codes.PARTS} AS w FROM k),
        x AS MATERIALIZED (SELECT r, i // w AS p, i % w AS j, floor(c * {codes.SCALE})::HUGEINT AS v FROM f),
        b0 AS (SELECT p, r - 1 AS e, j, v FROM x WHERE r <= {codes.ENTRIES}),
        {(','+chr(10)+'        ').join(rounds)},
        {nearest.format(r=codes.ROUNDS)},
        s AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{codes.ROUNDS}),
        o AS (SELECT r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{codes.ROUNDS} GROUP BY r)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN o USING (r), s"""


ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS head, unhex(sha1(html))::BIT::VARCHAR AS bits FROM p)
        SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
               list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                   16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
                   + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT)::INT, 1)), lambda a, b: a || b) AS payload_digest,
               CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> head THEN head END AS refers_to
        FROM f""",
    "op5_chat_formatting": rf"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        p AS (SELECT *, len(regexp_replace(role, '{_CONTROLS}', 'x\1', 'g')) + len(regexp_replace(text, '{_CONTROLS}', 'x\1', 'g')) + 20 AS n FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(n)::BIGINT AS formatted_chars
        FROM p GROUP BY conv_id""",
    "op11_trie": r"""
        WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS d,
                          coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        v AS (SELECT DISTINCT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) & 3 AS h FROM t),
        r AS (SELECT v.c, t.d, t.role, t.text FROM v JOIN t ON t.c = v.c - v.c % 20 AND t.d <= v.h
              UNION ALL SELECT v.c, t.d, t.role, t.text FROM v JOIN t ON t.c = v.c AND t.d > v.h),
        p AS (SELECT c, text, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS path FROM r),
        n AS (SELECT path, min(c) AS conv_id, length(path) // 32 AS depth, count(*) AS n_convs,
                     any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS words
              FROM (SELECT c, text, path FROM p UNION ALL SELECT c, '', '' FROM v) GROUP BY path),
        k AS (SELECT path[:-33] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
        o AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
        u AS (SELECT path[:32 * i] AS path, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
              FROM (SELECT *, unnest(range(depth + 1)) AS i FROM o) GROUP BY ALL),
        e AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ends
              FROM (SELECT v.c, coalesce(max(p.path), '') AS path FROM v LEFT JOIN p ON p.c = v.c GROUP BY v.c) GROUP BY path)
        SELECT o.conv_id, o.depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
               sha256(coalesce(ends, '')) AS ends_sha256
        FROM o JOIN u USING (path) LEFT JOIN e USING (path) LEFT JOIN n up ON o.depth > 0 AND up.path = o.path[:-33]""",
    "op12_substrings": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, r, w, unnest(range(1, len(w) - 48)) AS s FROM d),
        h AS (SELECT doc_id, r, s, min(doc_id) OVER (PARTITION BY md5(array_to_string(list_slice(w, s, s + 49), ' '))) AS least FROM s),
        i AS (SELECT doc_id, r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        c AS (SELECT i.r, i.i, word, bool_or(coalesce(h.doc_id > least, false))
                     OVER (PARTITION BY i.r ORDER BY i.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
              FROM i LEFT JOIN h ON h.r = i.r AND h.s = i.i),
        k AS (SELECT r, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (r)""",
    "op13_vector_codes": _vector_codes_sql(),
}
