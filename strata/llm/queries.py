"""Queries over the standard tables, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    byte_bpe, decontamination, embedding_join, html_text, importance, language_id, minhash, packing, secret_scan, suffix_dedup,
    url_filters, vector_codes, warc,
)
from strata.llm.common import Stages, table
from strata.llm.registry import ORACLES, QUERIES, query
from strata.session import run_folder

__all__ = ["ORACLES", "QUERIES"]

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query(r"""
    WITH rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
        ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    parts AS (SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3)
              ELSE '' END AS rest FROM pages)),
    fits AS (SELECT page_id, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC,
                           r.verdict DESC) AS place
        FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
    SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
    FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
""")
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's address."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge_urls(pages, url_filters.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(r"""
    WITH patterns(place, kind, pattern, part, least) AS (VALUES
        (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
        (1, 'access', 'AKIA[A-Z0-9]+', 0, 16),
        (2, 'hex', '[0-9a-f]+', 0, 32),
        (3, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1),
        (4, 'chat', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 1)),
    ASSIGN AS (SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), (SELECT pattern FROM patterns WHERE place = 0), 0) AS hits,
        regexp_extract_all(coalesce(text, ''), (SELECT pattern FROM patterns WHERE place = 0), 2) AS parts,
        string_split_regex(coalesce(text, ''), (SELECT pattern FROM patterns WHERE place = 0)) AS gaps FROM documents),
    walks AS (
        SELECT doc_id, place, kind, least, hits, parts, gaps FROM ASSIGN, patterns WHERE place = 0
        UNION ALL
        SELECT doc_id, place, kind, least, regexp_extract_all(coalesce(text, ''), pattern, 0) AS hits,
            regexp_extract_all(coalesce(text, ''), pattern, 0) AS parts,
            string_split_regex(coalesce(text, ''), pattern) AS gaps
        FROM documents, patterns WHERE place > 0),
    steps AS (SELECT doc_id, place, kind, least, generate_subscripts(hits, 1) AS n, unnest(hits) AS hit,
        unnest(parts) AS part, unnest(gaps[1:len(hits)]) AS gap FROM walks),
    placed AS (SELECT doc_id, place, kind, part, least,
        sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, place ORDER BY n) AS stop, length(hit) AS size
        FROM steps),
    found AS (SELECT doc_id, place, kind, (stop - size)::BIGINT AS start, stop::BIGINT AS stop
        FROM placed WHERE length(part) >= least),
    told AS (SELECT doc_id,
        count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
        count(*) FILTER (place = 2) AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM found GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN told USING (doc_id)
""")
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many secrets of each base kind every document has, and where all of them are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [rule.kind for rule in secret_scan.BASE_RULES]
    found = secret_scan.scan(docs)
    kinds = F.transform("findings", lambda f: f["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in base]
    first = F.filter("findings", lambda f: f["kind"].isin(base))
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.spelled(first), 256).alias("base_sha256"),
        secret_scan.spelled(F.col("findings")).alias("spans"),
    )


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, in pieces packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("""
    WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
        strlen(coalesce(html, '')) AS payload_bytes FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
    FROM firsts
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, archived and read back from the archives."""
    root = run_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), root)
    return warc.read(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near-duplicates (three words, 85 of 100)."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, percent=85)


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document that holds it, up to one edit for ten characters."""
    found = decontamination.leaks(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", F.col("item").alias("item_id"), "edits", "start", "end")


@query("""
    WITH good AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
        AND list_cosine_similarity(a.v, b.v) >= 0.9),
    reach AS (WITH RECURSIVE r(a, b) AS (SELECT vec_id, vec_id FROM good UNION
        SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a, min(b) AS component_id FROM r GROUP BY a)
    SELECT g.vec_id, count(l.b) AS n_links, any_value(r.component_id) AS component_id,
        g.vec_id = any_value(r.component_id) AS kept
    FROM good g JOIN reach r ON r.a = g.vec_id LEFT JOIN links l ON l.a = g.vec_id GROUP BY g.vec_id
""")
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links at a cosine of 0.9 and its component."""
    return embedding_join.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query()
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that earlier documents have."""
    left = suffix_dedup.repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The codebooks' rounds, one after the other, as common table expressions."""
    def nearest(book: str) -> str:
        gap = "list_sum(list_transform(range(1, len(w.x) + 1), lambda i: (w.x[i] - c.x[i]) * (w.x[i] - c.x[i])))"
        return f"""(SELECT vec_id, label, p, any_value(x) AS x, arg_min(e, far * {entries} + e) AS e, min(far) AS far FROM (
            SELECT w.vec_id, w.label, w.p, w.x, c.e, {gap} AS far FROM whole w JOIN {book} c ON w.p = c.p) GROUP BY vec_id, label, p)"""

    steps = []
    for r in range(rounds):
        steps.append(f"""near{r} AS MATERIALIZED {nearest(f"book{r}")},
        mean{r} AS (SELECT p, e, list(m ORDER BY i) AS x FROM (
            SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
            FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM near{r}) + 1)) AS i) GROUP BY p, e, i) GROUP BY p, e),
        book{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM book{r} c LEFT JOIN mean{r} m ON m.p = c.p AND m.e = c.e)""")
    return f"""
    WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    whole AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
        FROM kept, (SELECT unnest(range({parts})) AS p)),
    book0 AS MATERIALIZED (SELECT p, e, x FROM (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM whole) WHERE e < {entries}),
    {", ".join(steps)},
    done AS MATERIALIZED {nearest(f"book{rounds}")},
    coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
        FROM done GROUP BY vec_id, label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
    FROM coded
"""


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's code, its error, and that of all vectors with its label."""
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), carry=["label"])
    rows = Stages(spark, "vector-codes").keep(codes.rows, "coded")
    return vector_codes.with_total(rows, "label", "error", "label_error").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


@query(r"""
    WITH codes AS (SELECT list(c ORDER BY n) AS crc FROM (SELECT n, list_reduce(list_prepend(n, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS n))),
    told AS (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
    asked AS (SELECT unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
    counted AS (SELECT word, sum(s) AS s, sum(t) AS t FROM (
        SELECT word, count(*) AS s, 0 AS t FROM (SELECT unnest(words) AS word FROM told) GROUP BY word
        UNION ALL SELECT word, 0, count(*) FROM asked GROUP BY word) GROUP BY word),
    hashed AS MATERIALIZED (SELECT word, s, t, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
            list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))),
            lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM counted, codes),
    buckets AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM hashed GROUP BY bucket),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM buckets) + 10000)
        / ((s + 1) * ((SELECT sum(t) FROM buckets) + 10000)))) AS gain FROM buckets),
    weighed AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(words) AS word FROM told)
        JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
    drawn AS (SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
            (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
        FROM told LEFT JOIN weighed USING (doc_id)),
    ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM drawn WHERE n_features >= 20)
    SELECT d.doc_id, n_features, weight, score,
        CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranks) THEN rank END AS rank
    FROM drawn d LEFT JOIN ranks r USING (doc_id)
""")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's likeness to the benchmark's texts, and a tenth of the documents drawn by it."""
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and the bytes they stand for."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(ids, ranks).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
