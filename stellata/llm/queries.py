"""Registered queries of this subpackage and, where SQL can say it, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from stellata.llm import (ann, bpe, exact_dedup, linkrank, merkle, mixing, resample, secrets, simhash,
                          suffix_dedup, token_groups, toxicity, warc)
from stellata.llm.common import shared_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: (verdict, host, path) of the url rules.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    path = shared_path(spark, "archives")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.inventory(warc.read(spark, path))


def op2_mixing(spark, sf_dir):
    return (mixing.mix(_table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"))


def op3_url_verdicts(spark, sf_dir):
    return linkrank.verdicts(_table(spark, sf_dir, "pages"), RULES).withColumnRenamed("id", "page_id")


def op4_suffix_dedup(spark, sf_dir):
    removed = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return suffix_dedup.report(removed).withColumnRenamed("id", "doc_id")


def op5_secrets(spark, sf_dir):
    return secrets.report(secrets.scan(_table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op6_ann(spark, sf_dir):
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op7_bpe(spark, sf_dir):
    path = public_tokenizers.path(VOCABULARY)
    tokens = bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.digests(tokens).withColumnRenamed("id", "doc_id")


def op8_exact_dedup(spark, sf_dir):
    return (exact_dedup.classes(_table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                    F.col("sha256").alias("text_sha256")))


def op9_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
            .select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    F.size("spans").cast("long").alias("n_spans")))


def op10_simhash(spark, sf_dir):
    found = simhash.groups(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op11_ngram_join(spark, sf_dir):
    found = token_groups.groups(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op12_resample(spark, sf_dir):
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_merkle(spark, sf_dir):
    """Every second document (by the CRC-32 of its id) is told to have lost its line breaks."""
    number = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    tampered = F.when(number % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.verify(merkle.manifest(_table(spark, sf_dir, "documents"), other={"text": tampered}), "other")
    text = lambda c: F.lower(F.hex(c))
    return found.select(F.col("id").alias("doc_id"), text("hash").alias("leaf"), text("top").alias("subroot"),
                        text("t_top").alias("root"), "proof_sha256", text("folded").alias("folded_root"),
                        (F.col("folded") == F.col("t_top")).alias("verified"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_url_verdicts": op3_url_verdicts,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_secrets": op5_secrets,
    "op6_ann": op6_ann,
    "op7_bpe": op7_bpe,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_ngram_join": op11_ngram_join,
    "op12_resample": op12_resample,
    "op13_merkle": op13_merkle,
}

#: CRC-32 in SQL: the table of its 256 steps, and that of a list of bytes.
_CRC_TABLE = """
        crc AS (SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)), lambda v, _:
                       CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS step
                FROM range(256) t(i))"""


def _crc(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of a SQL text (with ``crc`` in scope)."""
    digits = f"hex(encode({text}))"
    octets = (f"list_transform(range(length({digits}) // 2), lambda k: "
              f"('0x' || substr({digits}, (2 * k + 1)::INT, 2))::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: "
            f"xor(c >> 8, crc.step[(xor(c, b) & 255) + 1])), 4294967295)")


SQL = {
    "op1_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest,
                     row_number() OVER (PARTITION BY html ORDER BY page_id DESC) AS place,
                     max(page_id) OVER (PARTITION BY html) AS newest FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND place > 1 THEN newest END AS refers_to
        FROM g
    """,
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS clean
                   FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY clean) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(clean) AS text_sha256
        FROM t
        WINDOW w AS (PARTITION BY clean ORDER BY points DESC, doc_id)
    """,
    "op2_mixing": r"""
        WITH d AS (SELECT doc_id, source, length(coalesce(text, '')) AS points,
                          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
                   FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        n AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS w,
                     3.0::DOUBLE * source_size AS lim FROM s),
        r AS (SELECT *, lim / w AS ratio FROM n),
        l AS (SELECT *, (sum(source_size) OVER ())::DOUBLE
                        - coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS remaining,
                     sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wsum
              FROM r WINDOW o AS (ORDER BY ratio, source IS NULL, source)),
        st AS (SELECT *, remaining * w / wsum >= lim AS stops FROM l),
        f AS (SELECT remaining, wsum FROM st WHERE NOT stops ORDER BY ratio, source IS NULL, source LIMIT 1),
        t AS (SELECT source, source_size,
                     CASE WHEN stops THEN lim ELSE (SELECT remaining FROM f) * w / (SELECT wsum FROM f) END AS target
              FROM st),
        k AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
                     CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs,
                     -ln((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
                         / 4503599627370496.0::DOUBLE)
                     / greatest(1.0::DOUBLE, least(4.0::DOUBLE,
                         1.0::DOUBLE + 3.0::DOUBLE * least(1.0::DOUBLE, 6.0::DOUBLE * size / greatest(points, 1)))) AS key
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        c AS (SELECT *, target - epochs * source_size AS budget,
                     coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM k)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (size * (epochs + CASE WHEN ahead < budget AND ahead + size / 2 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM c
    """,
    "op11_ngram_join": r"""
        WITH RECURSIVE t AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (SELECT DISTINCT r, unnest(CASE WHEN len(words) < 5 THEN list_filter([array_to_string(words, ' ')], lambda x: x <> '')
                  ELSE list_transform(range(1, len(words) - 3),
                                      lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END) AS g FROM t),
        n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
        p AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.g = b.g AND a.r < b.r
              GROUP BY a.r, b.r
              HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE r = a.r) + (SELECT n FROM n WHERE r = b.r) - count(*))),
        e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        c(r, reached) AS (SELECT r, r FROM t UNION SELECT c.r, e.b FROM c JOIN e ON c.reached = e.a),
        m AS (SELECT c.r, min(t.doc_id) AS component_id FROM c JOIN t ON t.r = c.reached GROUP BY c.r)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM t LEFT JOIN n USING (r) JOIN m USING (r)
    """,
    "op12_resample": rf"""
        WITH {_CRC_TABLE},
        texts AS (SELECT 0 AS kind, rowid AS r, doc_id, coalesce(text, '') AS text
                  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
                  UNION ALL SELECT 1, NULL, NULL, coalesce(text, '') FROM benchmark),
        w AS (SELECT kind, r, unnest(regexp_extract_all(
                     translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
        n AS (SELECT kind, r, word, count(*) AS n FROM w GROUP BY ALL),
        b AS (SELECT word, {_crc('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM n), crc),
        c AS (SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t
              FROM n JOIN b USING (word) GROUP BY bucket),
        a AS (SELECT sum(s) AS s, sum(t) AS t FROM c),
        g AS (SELECT bucket, floor(1000 * ln(((c.t + 1)::DOUBLE * (a.s + 10000)::DOUBLE)
                                             / ((c.s + 1)::DOUBLE * (a.t + 10000)::DOUBLE)))::BIGINT AS gain FROM c, a),
        d AS (SELECT r, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS total
              FROM n JOIN b USING (word) JOIN g USING (bucket) WHERE kind = 0 GROUP BY r),
        e AS (SELECT doc_id, r, coalesce(n, 0) AS n_features,
                     coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
                     ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h
              FROM texts LEFT JOIN d USING (r) WHERE kind = 0),
        f AS (SELECT doc_id, n_features, weight,
                     weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score,
                     n_features >= 20 AS able FROM e),
        o AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place,
                     count(*) OVER (PARTITION BY able) AS n FROM f)
        SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= n * 10 // 100 THEN place END AS rank
        FROM o
    """,
    "op13_merkle": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        t AS (SELECT *, CASE WHEN {_crc('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '')
                             ELSE text END AS bent FROM documents, crc),
        d AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     sha256(head || coalesce(strlen(bent) || ':' || bent, '-')) AS bent
              FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                              || coalesce(strlen(source) || ':' || source, '-')
                              || coalesce(strlen(lang) || ':' || lang, '-')
                              || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM t)),
        l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                     count(*) OVER (PARTITION BY source) AS n FROM d),
        low(source, lvl, pos, n, h) AS (
            SELECT source, 0, pos, n, leaf FROM l
            UNION ALL
            SELECT source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM low WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
        top AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
                FROM low WHERE n = 1),
        high(lvl, pos, n, h) AS (
            SELECT 0, pos, n, h FROM top
            UNION ALL
            SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
        -- one tree for both: the group number (-1 above), and every document's walk through it
        node AS (SELECT top.pos AS g, lvl, low.pos, low.n, low.h FROM low JOIN top ON low.source IS NOT DISTINCT FROM top.source
                 UNION ALL SELECT -1, lvl, pos, n, h FROM high),
        k AS (SELECT l.*, row_number() OVER () AS r, top.pos AS g, top.h AS subroot
              FROM l JOIN top ON l.source IS NOT DISTINCT FROM top.source),
        walk(r, g, lvl, pos, n, h, bent, step, sib) AS (
            SELECT r, g, 0, pos, n, leaf, bent, 0, '' FROM k
            UNION ALL
            SELECT r, CASE WHEN n > 1 THEN g ELSE -1 END, CASE WHEN n > 1 THEN lvl + 1 ELSE 0 END,
                   CASE WHEN n > 1 THEN pos // 3 ELSE g END, CASE WHEN n > 1 THEN (n + 2) // 3 ELSE top_n END,
                   CASE WHEN n > 1 THEN sha256(whole) ELSE h END, CASE WHEN n > 1 THEN sha256(folded) ELSE bent END,
                   step + 1, CASE WHEN n > 1 THEN sibs ELSE '' END
            FROM (SELECT w.r, w.g, w.lvl, w.pos, w.n, w.h, w.bent, w.step, (SELECT count(*) FROM top) AS top_n,
                         string_agg(node.h, '' ORDER BY node.pos) AS whole,
                         string_agg(CASE WHEN node.pos = w.pos THEN w.bent ELSE node.h END, '' ORDER BY node.pos) AS folded,
                         coalesce(string_agg(node.h, '' ORDER BY node.pos) FILTER (node.pos <> w.pos), '') AS sibs
                  FROM walk w JOIN node ON node.g = w.g AND node.lvl = w.lvl AND node.pos // 3 = w.pos // 3
                  WHERE w.n > 1 OR w.g >= 0
                  GROUP BY ALL)),
        done AS (SELECT r, sha256(string_agg(sib, '' ORDER BY step)) AS proof_sha256,
                        last(h ORDER BY step) AS root, last(bent ORDER BY step) AS folded_root FROM walk GROUP BY r)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM k JOIN done USING (r)
    """,
}
