"""The operators as registered queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.llm.chat import ASSISTANT, USER, as_events, masked, messages, parse, render
from tidebar.llm.decontaminate import find_items
from tidebar.llm.hard_negatives import hard_negatives
from tidebar.llm.html_text import extract
from tidebar.llm.language_id import identify
from tidebar.llm.lexical import ranked
from tidebar.llm.licenses import scan
from tidebar.llm.minhash import near_duplicates
from tidebar.llm.pieces import encode_and_decode
from tidebar.llm.token_counts import token_counts
from tidebar.llm.topk import quantized, top_k
from tidebar.llm.url_filters import judge
from tidebar.llm.warc import digest_column, read_warc, write_pages
from tidebar.session import scratch_dir


def piece_model() -> str:
    """The path of the tokenizer that queries use, as its package gives it on each machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    vectors = vectors.select(F.col("vec_id").cast("long"), quantized(F.col("embedding")).alias("vector"))
    asked = vectors.where(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id")
    return top_k(asked, vectors, 20)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages archived, then read back: responses by a pushed filter, with sizes and digests of the
    payloads read; revisits by another, from their headers alone."""
    path = scratch_dir(spark, "warc")
    write_pages(_table(spark, sf_dir, "pages"), path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = read_warc(spark, path, [*columns, "payload"]).where("record_type = 'response'")
    revisits = read_warc(spark, path, columns).where("record_type = 'revisit'")
    seen = responses.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest_column(F.col("payload")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    return seen.unionByName(revisits)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text again."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_and_decode(docs, piece_model())
    plain = F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return out.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == plain).alias("round_trip"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted, and what the formatted text alone gives back."""
    talks = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, USER).otherwise(ASSISTANT).alias("role"),
        F.lit(odd).alias("text"),
    )
    out = render(messages(as_events(talks.unionByName(extra))))
    turns = parse(F.col("formatted"))
    line = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = masked(F.col("formatted"), F.col("loss"))
    return out.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(line, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts(docs, piece_model(), scratch_dir(spark, "token-counts"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


#: Rules of the query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages judged by the rules; redirects are the canonical and refresh links of the pages."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(_table(spark, sf_dir, "pages"), rules)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").where("vec_id is not null and label is not null")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), quantized(F.col("embedding"), 256).alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_warc": op2_warc,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_license_scan": op4_license_scan,
        "op5_chat_format": op5_chat_format,
        "op6_benchmark_decontamination": op6_benchmark_decontamination,
        "op7_language_id": op7_language_id,
        "op8_token_counts": op8_token_counts,
        "op9_html_extraction": op9_html_extraction,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_url_filters": op11_url_filters,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_ranked_lexical_search": op13_ranked_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": _TOP_K,
        "op2_warc": _warc_sql(),
        "op5_chat_format": _chat_sql(),
        "op10_minhash_near_dedup": _NEAR_DUPLICATES,
        "op11_url_filters": _URL_FILTERS,
        "op12_hard_negatives": _HARD_NEGATIVES,
        "op13_ranked_lexical_search": _LEXICAL,
    }


_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""


def _warc_sql() -> str:
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((p{part} >> {shift}) & 31), 1)"
    digest = " || ".join(
        letter.format(part=part, shift=35 - 5 * i) for part in range(4) for i in range(8)
    )
    parts = ", ".join(f"CAST('0x' || substr(x, {1 + 10 * i}, 10) AS BIGINT) AS p{i}" for i in range(4))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first_id, {parts} FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {digest} AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


def _chat_sql() -> str:
    pattern = r"([<\[])(\\*/?(?:s>|ROLE\]|INST\]))"
    escaped = rf"regexp_replace({{0}}, '{pattern}', '\1\\\2', 'g')"
    size = " + ".join(f"length({escaped.format(c)})" for c in ("role", "text"))
    return f"""
WITH m AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        3 + sum(13 + 4 + {size} + CASE WHEN role = 'user' THEN 15 ELSE 0 END) AS n
    FROM m GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM g
"""


_TERMS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
_LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS length FROM d WHERE len(t) > 0),
i AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest({_TERMS}) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL))
    GROUP BY item_id, term
), c AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY row, doc_id, n, term
), w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM c, s GROUP BY term, docs
), x AS (
    SELECT item_id, row, doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) AS BIGINT) AS score
    FROM c JOIN i USING (term) JOIN w USING (term), s WHERE doc_id IS NOT NULL
    GROUP BY item_id, row, doc_id
)
SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER o <= 10
"""


_HARD_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
        CAST(list_inner_product(CAST(a.x AS DOUBLE[]), CAST(r.x AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""


#: No page of the tables names another address, so rules alone decide; `tests/llm` covers links.
_URL_FILTERS = r"""
WITH p AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), r(domain, start, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), h AS (
    SELECT p.page_id, arg_max(domain || start, length(domain || start)) AS rule,
        arg_max(verdict, length(domain || start)) AS verdict
    FROM p JOIN r ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
    GROUP BY p.page_id
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN h ON p.page_id = h.page_id
"""


#: Exact sets: all pairs that share a shingle, of classes of equal sets, and what they reach.
_NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS x
    FROM d
), sizes AS (
    SELECT doc_id, count(*) AS n, md5(string_agg(x, '' ORDER BY x)) AS whole FROM s GROUP BY doc_id
), classes AS (
    SELECT doc_id, n, min(doc_id) OVER (PARTITION BY whole) AS node FROM sizes
), own AS (
    SELECT s.doc_id AS node, n, x FROM s JOIN classes c ON s.doc_id = c.doc_id WHERE c.doc_id = c.node
), pairs AS (
    SELECT a.node AS a, b.node AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS common
    FROM own a JOIN own b ON a.x = b.x AND a.node <> b.node GROUP BY a.node, b.node
), links AS (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (an + bn - common)),
reached(node, root) AS (
    SELECT DISTINCT node, node FROM classes
    UNION SELECT b, root FROM reached JOIN links ON a = node
), roots AS (SELECT node, min(root) AS root FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
    coalesce(root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN classes c ON d.doc_id = c.doc_id LEFT JOIN roots r ON r.node = c.node
"""
