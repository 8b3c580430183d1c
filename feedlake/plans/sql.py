"""Named table expressions in DuckDB's SQL, twins of the views in `adapters`."""

from __future__ import annotations

from feedlake import fixed

# Space and symbol classes in RE2's notation, of the fixed values.
_KEPT = "".join(f"\\{c}" if c in "-." else c for c in fixed.KEPT_SYMBOLS).replace("'", "''")
ASCII_SPACE = "[" + "".join(f"\\x{ord(c):02x}" for c in fixed.SPACES_ASCII) + "]+"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
DROP_ASCII = rf"[^\w\s{_KEPT}]"
DROP_UNICODE = rf"[^{fixed.KEPT_UNICODE}{_KEPT}]"


def normalize(text: str) -> str:
    return (
        f"regexp_replace(regexp_replace(trim({text}, ' '), '{ASCII_SPACE}', ' ', 'g'), "
        f"'{DROP_ASCII}', '', 'g')"
    )


def squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}', ' ', 'g'), ' ')"


def normalize_unicode(text: str) -> str:
    return f"regexp_replace({squeeze(text)}, '{DROP_UNICODE}', '', 'g')"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{SPACE}'), lambda w: w <> '')"


def content_hash(text: str) -> str:
    return (
        f"CASE WHEN coalesce({text}, '') = '' THEN '' ELSE sha256(lower({squeeze(text)})) END"
    )


def tokens(text: str) -> str:
    return (
        f"CASE WHEN coalesce({text}, '') = '' THEN 0 "
        f"ELSE greatest(floor(len({words(text)}) / 0.75::DOUBLE), 1) END::INTEGER"
    )


def namespace(region: str) -> str:
    return (
        f"coalesce(nullif(replace(lower(regexp_replace({region}, "
        f"'^{SPACE}|{SPACE}$', '', 'g')), ' ', '_'), ''), 'global')"
    )


def region_of(source: str) -> str:
    return (
        f"CASE substr({source}, 4)::INTEGER % 3 WHEN 0 THEN 'global' WHEN 1 THEN 'emea' "
        "ELSE 'americas' END"
    )


def chunks(size: int, overlap: int, source: str, keep: str) -> str:
    """Rows of ``source`` (with ``content``) exploded to chunk_index and chunk_text."""
    step = size - overlap
    return f"""
    SELECT {keep}, i::INTEGER AS chunk_index,
           array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ') AS chunk_text
    FROM (
      SELECT *, unnest(generate_series(
               0, greatest(ceil((len(w) - {size}) / {step}::DOUBLE), 0)::BIGINT)) AS i
      FROM (SELECT *, {words("content")} AS w FROM {source})
    )"""


BRONZE_COLUMNS = (
    "article_id, feed_id, region, source_type, source_url, title, summary, body, published_at, "
    "language_hint, raw_payload, ingested_at, ingestion_date"
)
_CHUNK_KEEP = (
    "article_id, feed_id, region, language, published_at, source_url, ingestion_date, ordinal"
)


def _silver(source: str, content: str, normalized, hashed, keep: str, language: str, key: str,
            order: str) -> str:
    return f"""
    SELECT article_id, feed_id, region, {normalized("coalesce(title, '')")} AS title, content,
           content_hash, {language} AS language, published_at, source_url, ingested_at,
           ingestion_date, doc_id AS ordinal
    FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
      FROM (SELECT *, {hashed("content")} AS content_hash
            FROM (SELECT *, {normalized(content)} AS content FROM {source}) WHERE {keep})
    ) WHERE rn = 1"""


CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "articles": (
        f"""
    SELECT doc_id, source || '_' || substr(sha256(source || ':http://' || source || '/' || doc_id),
                                           1, {fixed.ARTICLE_HASH_CHARS}) AS article_id,
           source AS feed_id, {region_of("source")} AS region, 'rss' AS source_type,
           'http://' || source || '/' || doc_id AS source_url,
           'Document ' || doc_id AS title,
           CASE WHEN doc_id % 25 <> 0 THEN text END AS summary,
           CASE WHEN doc_id % 10 <> 0 THEN text END AS body,
           CASE WHEN doc_id % 7 <> 0 THEN TIMESTAMP '2025-01-01' + to_hours(doc_id % 24) END
             AS published_at,
           CASE WHEN doc_id % 11 <> 0 THEN upper(lang) END AS language_hint,
           '{{"doc_id":' || doc_id || '}}' AS raw_payload,
           TIMESTAMP '2025-01-01 06:00:00' AS ingested_at,
           DATE '2025-01-01' + (doc_id % 3)::INTEGER AS ingestion_date
    FROM documents""",
        (),
    ),
    "late_copies": (
        """
    SELECT * REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at, 'Late ' || title AS title)
    FROM articles WHERE language_hint = 'FR'""",
        ("articles",),
    ),
    "articles_dup": (
        "SELECT * FROM articles UNION ALL SELECT * FROM late_copies", ("late_copies",),
    ),
    "bronze_dup": (
        """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY article_id, ingestion_date
                                   ORDER BY ingested_at DESC) AS rn
      FROM articles_dup) WHERE rn = 1""",
        ("articles_dup",),
    ),
    "silver": (
        _silver(
            "articles", "coalesce(body, summary, title)", normalize, content_hash,
            f"length(content) > {fixed.MIN_CONTENT_CHARS}",
            "coalesce(lower(language_hint), 'unknown')", "content_hash, ingestion_date",
            "ingested_at DESC, article_id",
        ),
        ("articles",),
    ),
    "local_silver": (
        _silver(
            "articles", "coalesce(nullif(body, ''), nullif(summary, ''), nullif(title, ''), '')",
            normalize_unicode, lambda c: f"sha256({c})",
            f"length(content) >= {fixed.MIN_CONTENT_CHARS}",
            "coalesce(lower(nullif(language_hint, '')), 'unknown')", "content_hash",
            "doc_id",
        ),
        ("articles",),
    ),
    "gold": (
        f"""
    SELECT article_id || '_' || chunk_index AS chunk_id, *, {tokens("chunk_text")} AS token_count
    FROM ({chunks(384, 48, "silver", _CHUNK_KEEP)})
    WHERE length(chunk_text) > {fixed.MIN_CHUNK_CHARS}""",
        ("silver",),
    ),
    "local_gold": (
        f"""
    SELECT article_id || '_' || chunk_index AS chunk_id, *, {tokens("chunk_text")} AS token_count
    FROM ({chunks(380, 60, "local_silver", _CHUNK_KEEP)})""",
        ("local_silver",),
    ),
    "hourly_articles": (
        """
    SELECT * REPLACE (
      CASE WHEN language_hint = 'FR' THEN array_to_string(list_filter(string_split(body, ' '),
        lambda x, i: i % 2 = 1), ' ') ELSE body END AS body,
      CASE WHEN language_hint = 'FR' THEN array_to_string(list_filter(string_split(summary, ' '),
        lambda x, i: i % 2 = 1), ' ') ELSE summary END AS summary,
      CASE WHEN language_hint = 'FR' THEN ingested_at + INTERVAL 1 HOUR ELSE ingested_at END
        AS ingested_at)
    FROM articles""",
        ("articles",),
    ),
    "hourly_silver": (
        _silver(
            "hourly_articles", "coalesce(body, summary, title)", normalize, content_hash,
            f"length(content) > {fixed.MIN_CONTENT_CHARS}",
            "coalesce(lower(language_hint), 'unknown')", "content_hash, ingestion_date",
            "ingested_at DESC, article_id",
        ),
        ("hourly_articles",),
    ),
    "hourly_gold": (
        f"""
    SELECT article_id || '_' || chunk_index AS chunk_id, *, {tokens("chunk_text")} AS token_count
    FROM ({chunks(384, 48, "hourly_silver", _CHUNK_KEEP)})
    WHERE length(chunk_text) > {fixed.MIN_CHUNK_CHARS}""",
        ("hourly_silver",),
    ),
    "half_embedded": (
        """
    SELECT *, CASE WHEN chunk_index % 2 = 0 THEN TIMESTAMP '2025-02-01' END AS embedded_at
    FROM gold""",
        ("gold",),
    ),
    "vectors": (
        """
    SELECT vec_id::VARCHAR AS id, ['global', 'emea', 'americas'][label % 3 + 1] AS namespace,
           ['en', 'de', 'es', 'fr'][vec_id % 4 + 1] AS language,
           embedding::DOUBLE[] AS vals, label
    FROM embeddings""",
        (),
    ),
    "label_queries": (
        f"""
    SELECT label::VARCHAR AS query_id, region, {namespace("region")} AS namespace,
           CASE WHEN label % 2 = 0 THEN 'en' END AS language, embedding
    FROM (
      SELECT label, CASE label % 3 WHEN 1 THEN ' EMEA ' WHEN 2 THEN 'Americas' END AS region,
             list(x ORDER BY pos) AS embedding
      FROM (SELECT label, pos, avg(vals[pos]) AS x FROM (
              SELECT label, vals, unnest(generate_series(1, len(vals))) AS pos FROM vectors)
            GROUP BY label, pos)
      GROUP BY label)""",
        ("vectors",),
    ),
    "vector_queries": (
        f"""
    SELECT id AS query_id, region, {namespace("region")} AS namespace,
           CASE WHEN label % 2 = 0 THEN 'en' END AS language, vals AS embedding
    FROM (
      SELECT *, CASE label % 3 WHEN 1 THEN ' EMEA ' WHEN 2 THEN 'Americas' END AS region
      FROM vectors WHERE id::BIGINT % 20 = 0)""",
        ("vectors",),
    ),
    "requests": (
        """
    SELECT conv_id || '_' || turn AS query_id, text AS query,
           CASE conv_id % 3 WHEN 1 THEN 'emea' WHEN 2 THEN 'Americas' END AS region,
           CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN '' END AS language,
           's' || conv_id AS session_id
    FROM conversations WHERE role = 'user'
    UNION ALL SELECT 'x1', 'that tion there', NULL, NULL, 's'
    UNION ALL SELECT 'x2', 'zzzz qqqq', NULL, NULL, 's'
    UNION ALL SELECT 'x3', 'a of', NULL, NULL, 's'""",
        (),
    ),
    "model_outputs": (
        """
    SELECT conv_id, turn, ((conv_id + turn) % 12)::INTEGER AS kind, text,
      CASE (conv_id + turn) % 12
        WHEN 0 THEN '{"route":"trend_analyzer","confidence":0.9,"detected_region":"emea","rationale":' || j || '}'
        WHEN 1 THEN '{"route":"procurement_planner","confidence":1.7,"rationale":' || j || '}'
        WHEN 2 THEN '{"route":"procurement_planner","confidence":"0.8","x":1,"rationale":' || j || '}'
        WHEN 3 THEN '{"route":"x","confidence":0.5,"rationale":"supplier","summary":' || j || '}'
        WHEN 4 THEN text
        WHEN 5 THEN '[1, ' || j || ']'
        WHEN 6 THEN '{"route":"trend_analyzer","confidence":NaN,"rationale":"r","summary":' || j || '}'
        WHEN 7 THEN '{"route":"trend_analyzer","confidence":0.5,"rationale":5,"executive_summary":' || j || '}'
        WHEN 8 THEN '{"route":"trend_analyzer","confidence":0.5,"key_trends":["a","b"],"summary":' || j || '}'
        WHEN 9 THEN 'SOURCING now ' || text
        WHEN 10 THEN ''
        ELSE '{"route":"trend_analyzer","confidence":null,"supplier_risks":[],"rationale":' || j || '}'
      END AS raw
    FROM (SELECT *, to_json(text)::VARCHAR AS j FROM conversations)""",
        (),
    ),
}


def with_ctes(*names: str, select: str) -> str:
    """A statement with the named expressions and all they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    body = ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered)
    return f"WITH {body}\n{select}"
