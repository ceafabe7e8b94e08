"""DuckDB CTE text for the adapter views (mirrors lectern.sources)."""

DOCS = """docs_articles AS (
    SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS body, lang AS category
    FROM documents)"""

PAGES = """pages_articles AS (
    SELECT page_id AS doc_id,
           nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
           html AS body,
           nullif(regexp_extract(html, 'lang="([^"]*)"', 1), '') AS category
    FROM pages)"""

LANG_CASE = """CASE category WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3
        ELSE NULL END"""

# Topic classes for logits: 0 business, 1 entertainment, 2 politics, 3 sport, 4 tech.
TOPIC_NAME = """list_extract(['business','entertainment','politics','sport','tech'], {x} + 1)"""

LOGITS = """logits AS (
    SELECT vec_id AS doc_id,
           list_transform(embedding[1:5], lambda x: CAST(x AS DOUBLE) * 10) AS z,
           CAST(label % 5 AS BIGINT) AS y
    FROM embeddings),
scored AS (
    SELECT doc_id, z, y, list_transform(e, lambda x: x / list_sum(e)) AS probs,
           CAST(list_position(z, list_max(z)) - 1 AS BIGINT) AS pred
    FROM (SELECT *, list_transform(z, lambda x: exp(x - list_max(z))) AS e FROM logits)),
scored2 AS (
    SELECT *, probs[pred + 1] AS confidence FROM scored)"""

PREDICTIONS = LOGITS + """,
predictions AS (
    SELECT doc_id,
           CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS prediction_date,
           """ + TOPIC_NAME.format(x="y") + """ AS true_label,
           """ + TOPIC_NAME.format(x="pred") + """ AS predicted_label,
           round(confidence, 6) AS confidence,
           round(probs[1], 6) AS score_business,
           round(probs[2], 6) AS score_entertainment,
           round(probs[3], 6) AS score_politics,
           round(probs[4], 6) AS score_sport,
           round(probs[5], 6) AS score_tech,
           y = pred AS correct
    FROM scored2)"""

METRIC_HISTORY = """per_day AS (
    SELECT event_type AS run, CAST(ts AS DATE) AS day,
           round(avg(CASE WHEN value > 20 THEN 1.0 ELSE 0.0 END), 6) AS val_acc,
           round(avg(CASE WHEN value > 15 THEN 1.0 ELSE 0.0 END), 6) AS train_acc,
           round(avg(value), 6) AS val_loss,
           round(avg(value * 0.9), 6) AS train_loss
    FROM events GROUP BY 1, 2),
stepped AS (
    SELECT *, CAST(dense_rank() OVER (PARTITION BY run ORDER BY day) AS BIGINT) AS step FROM per_day),
metric_history AS (
    SELECT run, step, 'train_loss' AS key, train_loss AS value FROM stepped
    UNION ALL SELECT run, step, 'train_acc', train_acc FROM stepped
    UNION ALL SELECT run, step, 'val_loss', val_loss FROM stepped
    UNION ALL SELECT run, step, 'val_acc', val_acc FROM stepped)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

ARTICLES = DOCS + """,
src AS (
    SELECT doc_id, title, category, body AS text, CAST(""" + LANG_CASE + """ AS BIGINT) AS label
    FROM docs_articles
    WHERE body IS NOT NULL AND category IS NOT NULL AND title IS NOT NULL)"""

RANKED = ARTICLES + """,
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY md5(title) NULLS FIRST, doc_id) AS BIGINT) AS rn
    FROM src),
splitted AS (
    SELECT *, CASE WHEN rn % 100 < 10 THEN 'test' WHEN rn % 100 < 10 + 10 THEN 'val' ELSE 'train' END AS split
    FROM ranked)"""


def tok_sql(x: str) -> str:
    return r"list_filter(regexp_split_to_array(lower(" + x + r"), '[^\p{L}]+'), lambda t: t <> '')"


VOCAB = RANKED + """,
train AS (SELECT * FROM splitted WHERE split = 'train'),
vc AS (SELECT token, count(*) AS n FROM (SELECT unnest(""" + tok_sql("text") + """) AS token FROM train) GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS BIGINT) AS token_id, n FROM vc),
dtok AS (SELECT doc_id, unnest(l) AS token, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos
         FROM (SELECT doc_id, """ + tok_sql("body") + """ AS l FROM docs_articles)),
dids AS (SELECT doc_id, pos, token, CAST(coalesce(token_id, 1) AS BIGINT) AS token_id FROM dtok LEFT JOIN vocab USING (token)),
idl AS (SELECT d.doc_id, coalesce(list(token_id ORDER BY pos) FILTER (WHERE token_id IS NOT NULL), []) AS ids
        FROM docs_articles d LEFT JOIN dids USING (doc_id) GROUP BY d.doc_id)"""
