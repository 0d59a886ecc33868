"""DuckDB SQL with the same result as each registered query."""

from __future__ import annotations

from newscov.functions import text as T
from newscov.functions.answers import ANSWER_MARKER, MISSING_KEY_MICRO
from newscov.operators import prompts as P
from newscov.registry import queries as Q
from newscov.registry.views import CODES
from newscov.taxonomy import (
    DISPLAY_NAMES,
    EXPLORER_SPELLINGS,
    FRENCH_MONTHS,
    MACRO_CODES,
    METRIC_CODES,
    MODEL_ENERGY,
    PUBLISHED_RUN,
    REACHABLE_CODES,
    THEME_CODES,
    THEMES,
    explorer_codes,
)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _values(rows, columns: str) -> str:
    def cell(v):
        return _q(v) if isinstance(v, str) else f"{v}e0" if isinstance(v, float) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({columns}))"


def _pick(values, index: str) -> str:
    return f"list_extract({_list(values)}, CAST(({index}) % {len(values)} + 1 AS INT))"


def _match(keys, values, key: str) -> str:
    """Value at the place of ``key`` among ``keys``; null when absent."""
    return f"list_extract({_list(values)}, list_position({_list(keys)}, {key}))"


def _code(label: str) -> str:
    return _match((*REACHABLE_CODES, *DISPLAY_NAMES), (*REACHABLE_CODES, *CODES), label)


def _explorer_code(label: str) -> str:
    return f"coalesce({_code(label)}, {_match(EXPLORER_SPELLINGS, EXPLORER_SPELLINGS.values(), label)})"


def _theme(code: str) -> str:
    codes = [c for t in THEMES for c in THEME_CODES[t]]
    return _match(codes, [t for t in THEMES for _ in THEME_CODES[t]], code)


def _name(index: str) -> str:
    return _pick(DISPLAY_NAMES, index)


# --- views ---------------------------------------------------------------------

ARTICLES = """articles AS (
SELECT event_id AS article_id, ts AS date,
       CASE event_id % 8
         WHEN 0 THEN substr(CAST(ts AS STRING), 1, 10)
         WHEN 1 THEN substr(CAST(ts AS STRING), 1, 19)
         WHEN 2 THEN concat(substr(CAST(ts AS STRING), 6, 2), '/', substr(CAST(ts AS STRING), 9, 2), '/', substr(CAST(ts AS STRING), 1, 4))
         WHEN 3 THEN 'juil-24' WHEN 4 THEN strftime(ts, '%m-%d-%Y') WHEN 5 THEN strftime(ts, '%-d %b %Y')
         WHEN 6 THEN strftime(ts, '%Y%m%d') ELSE strftime(ts, '%B %-d, %Y') END AS raw_date,
       concat('media', CAST(user_id % 6 AS STRING)) AS media,
       CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS label,
       0.5e0 + value / 1000e0 AS confidence
FROM events)"""

SCORED = ARTICLES + """, scored AS (
SELECT *, CASE WHEN confidence > 0.55e0 THEN 1 ELSE 0 END AS predicted FROM articles)"""

PREDICTIONS = f"""predictions AS (
SELECT doc_id, DATE '2024-01-01' + CAST(doc_id % 366 AS INT) AS date, source AS media, text AS description,
       CASE WHEN doc_id % 2 = 0 THEN {_pick(CODES, "doc_id")} ELSE {_name("doc_id")} END AS label_1,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE {_pick(CODES, "doc_id * 7 + 5")} END AS label_2,
       CASE WHEN doc_id % 2 = 0 THEN NULL ELSE {_name("doc_id * 11 + 2")} END AS label_3,
       CASE WHEN doc_id % 13 = 0 THEN 'Catégorie inventée'
            WHEN doc_id % 5 < 3 THEN {_name("doc_id")} ELSE {_name("doc_id * 13 + 1")} END AS prediction_label_1,
       CASE WHEN doc_id % 7 = 0 THEN '[None, None]'
            WHEN doc_id % 4 < 2 THEN {_name("doc_id * 7 + 5")} ELSE {_name("doc_id * 3 + 9")} END AS prediction_label_2,
       CASE WHEN doc_id % 7 = 0 THEN '[None, None]' WHEN doc_id % 11 = 0 THEN NULL
            ELSE {_name("doc_id * 17 + 4")} END AS prediction_label_3
FROM documents)"""

GAPPY = "gappy AS (SELECT doc_id, text, quality FROM documents LEFT JOIN labels USING (doc_id))"

EXPLORER = PREDICTIONS + f""", coded AS (
SELECT doc_id, date, media, label_1, label_2, label_3,
       {_explorer_code("prediction_label_1")} AS prediction_label_1,
       {_explorer_code("prediction_label_2")} AS prediction_label_2,
       {_explorer_code("prediction_label_3")} AS prediction_label_3
FROM predictions),
shown AS (
SELECT * FROM coded
WHERE coalesce(prediction_label_1 IN {_in(explorer_codes())}, TRUE)
  AND coalesce(prediction_label_2 IN {_in(explorer_codes())}, TRUE)
  AND coalesce(prediction_label_3 IN {_in(explorer_codes())}, TRUE)),
long AS (
SELECT doc_id, date, unnest([prediction_label_1, prediction_label_2, prediction_label_3]) AS category FROM shown)"""


MACRO = f"""macro AS (
SELECT doc_id, DATE '2024-01-01' + CAST(doc_id % 366 AS INT) AS date, source AS media,
       {_pick(MACRO_CODES, "doc_id * 3")} AS label_1, CAST(NULL AS STRING) AS label_2, CAST(NULL AS STRING) AS label_3,
       CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'hors sujet'
            WHEN doc_id % 3 = 0 THEN {_pick(MACRO_CODES, "doc_id * 3")}
            ELSE {_pick(MACRO_CODES, "doc_id * 7 + 1")} END AS prediction_label_1 FROM documents),
shown_macro AS (SELECT * FROM macro WHERE coalesce(prediction_label_1 IN {_in(MACRO_CODES)}, TRUE)),
macro_lists AS (
SELECT doc_id, [label_1] AS truth, [x FOR x IN [prediction_label_1] IF x IS NOT NULL] AS predicted FROM macro)"""


def _coded_list(prefix: str) -> str:
    columns = ", ".join(f"{prefix}_{i}" for i in (1, 2, 3))
    return f"[{_code('x')} for x in [{columns}] if {_code('x')} IS NOT NULL]"


LISTS = PREDICTIONS + f""", lists AS (
SELECT doc_id, media, {_coded_list("label")} AS truth, {_coded_list("prediction_label")} AS predicted
FROM predictions)"""

RESPONSES = f"""responses AS (
SELECT conv_id, turn, {_name("conv_id * 3 + turn")} AS one, {_name("conv_id * 5 + turn * 2")} AS two,
       (conv_id + turn) % 5 AS kind,
       concat(replace(replace(text, '{{', '('), '}}', ')'), ' ',
         CASE kind
           WHEN 0 THEN concat('{{"Classe_1": "', one, '", "Classe_2": "', two, '", "Classe_3": "Pollution"}}')
           WHEN 1 THEN concat('{{"Classe_1": "', one, '"}} {{"Classe_1": "Pollution"}}')
           WHEN 2 THEN concat('{{"Classe_1": ', one, '}}')
           WHEN 3 THEN 'sans accolades'
           ELSE concat('{{"Classe_1": "', one, '", "Classe_2": null}}') END) AS bare,
       concat('{{x}} ', {_q(ANSWER_MARKER)}, bare) AS response
FROM conversations)"""

BLOCKS = RESPONSES + f""", blocks AS (
SELECT conv_id, turn, nullif(regexp_extract(string_split(response, {_q(ANSWER_MARKER)})[-1], '\\{{[^{{}}]*\\}}'), '') AS block
FROM responses),
checked AS (SELECT *, block IS NOT NULL AND json_valid(block) AS readable FROM blocks)"""


# --- pieces shared by several queries --------------------------------------------


def _coverage(period: str) -> str:
    return f"""WITH {ARTICLES}
SELECT CAST(CAST(date_trunc('{period}', date) AS DATE) AS STRING) AS period,
       count(*) AS total_articles, count(*) FILTER (WHERE label = 1) AS articles_climat,
       round(100e0 * count(*) FILTER (WHERE label = 1) / count(*), 6) AS ratio
FROM articles WHERE date IS NOT NULL GROUP BY 1"""


def _rolling(partition: str) -> str:
    frame = f"({partition} ORDER BY media, date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"
    return f"""WITH {ARTICLES}, shares AS (
SELECT media, date, avg(label) AS label, avg(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS selected
FROM articles GROUP BY ALL)
SELECT media, CAST(date AS STRING) AS date, round(avg(label) OVER {frame}, 6) AS proportion,
       round(avg(selected) OVER {frame}, 6) AS proportion_selected
FROM shares"""


def _counts(categories, macro: bool = False) -> str:
    view, source = (MACRO, "shown_macro") if macro else (EXPLORER, "long")
    column = "prediction_label_1 AS category" if macro else "category"
    return f"""WITH {view}, counts AS (
SELECT s.category, coalesce(c.n, 0) AS n
FROM (SELECT unnest({_list(categories)}) AS category) s
LEFT JOIN (SELECT category, count(*) AS n FROM (SELECT {column} FROM {source}) GROUP BY 1) c USING (category))"""


def _metrics(lists: str, key: str, top: int | str = 3, codes=METRIC_CODES) -> str:
    """Metric columns per ``key`` over a relation with key, doc_id, truth, predicted."""
    return f"""(WITH pairs AS (
  SELECT {key} AS k, l.label, list_contains(truth, l.label) AS t, list_contains(predicted, l.label) AS p
  FROM {lists}, (SELECT unnest({_list(codes)}) AS label) l),
 per_label AS (
  SELECT k, label, count(*) FILTER (WHERE t AND p) AS hit, count(*) FILTER (WHERE p) AS guessed,
         count(*) FILTER (WHERE t) AS support
  FROM pairs GROUP BY 1, 2),
 weighted AS (
  SELECT k,
    round(100e0 * sum(coalesce(hit / nullif(guessed, 0), 0) * support) / sum(support), 2) AS precision,
    round(100e0 * sum(coalesce(hit / nullif(support, 0), 0) * support) / sum(support), 2) AS recall,
    round(100e0 * sum(coalesce(2e0 * hit / nullif(guessed + support, 0), 0) * support) / sum(support), 2) AS f1
  FROM per_label GROUP BY 1),
 plain AS (
  SELECT {key} AS k,
    round(100e0 * count(*) FILTER (WHERE list_contains(truth, predicted[1])) / count(*), 2) AS top1,
    round(100e0 * count(*) FILTER (WHERE list_has_any(predicted[1:{top}], truth)) / count(*), 2) AS top3,
    round(100e0 * count(*) FILTER (WHERE len(predicted) = 0) / count(*), 2) AS unsure
  FROM {lists} GROUP BY 1)
SELECT k, precision, recall, f1, top1, top3, unsure FROM weighted JOIN plain USING (k))"""


def _normalised(column: str) -> str:
    expression = f"lower({column})"
    for ligature, letters in (*T.LIGATURES, *T.DIGRAPHS):
        expression = f"replace({expression}, {_q(ligature)}, {_q(letters)})"
    return f"translate({expression}, {_q(T.SINGLE)}, {_q(T.SINGLE_LATIN)})"


CLEAN = rf"""clean AS (
SELECT doc_id, [w for w in regexp_extract_all(regexp_replace({_normalised("text")}, {_q(T.CONTRACTION)}, '\1 \2', 'g'), '[\p{{L}}\p{{N}}_''’]+')
                if regexp_full_match(w, '\p{{L}}+') AND NOT list_contains({_list(T.stop_words("french"))}, w)] AS words
FROM documents)"""

SALIENT = f"""{CLEAN}, counts AS (
SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS word FROM clean) GROUP BY 1, 2),
weighted AS (
SELECT doc_id, word, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (count(*) OVER (PARTITION BY word) + 1)), 6) AS weight
FROM counts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, word) AS rank FROM weighted)"""

_RUN = "['COT_0shots', 'CARP_0shots', 'COT_1shots'][CAST(doc_id % 3 + 1 AS INT)]"
_MARCH = FRENCH_MONTHS.index("Mars") + 1
_MESSAGE = len(Q.REFINE_MESSAGE)


def _around(template: str, text: str) -> str:
    before, _, after = template.partition("{text}")
    return f"concat({_q(before)}, {text}, {_q(after)})"


_GRID = [
    ("model", method, n, P.method_message(method, n, Q.EXAMPLES)) for method in P.METHODS for n in (0, 1)
]

_SPACED = '{ "Classe_1": "categorie_1", "Classe_2": "categorie_2", "Classe_3": "categorie_3" }'

_ANSWER = (
    """concat('{"Classe_1": "', coalesce(label_1, 'None'), '",', chr(10), '"Classe_2": "', """
    """coalesce(label_2, 'None'), '",', chr(10), '"Classe_3": "', coalesce(label_3, 'None'), '"}', chr(10))"""
)

_PLACEHOLDER = ", ".join(
    f"""CASE WHEN list_contains(json_keys(block), 'Classe_{i}') THEN json_extract_string(block, '$.Classe_{i}')
       ELSE {_q(MISSING_KEY_MICRO)} END AS prediction_label_{i}"""
    for i in (1, 2, 3)
)

_COMPARED = ", ".join(f"('{m}')" for m in ("precision", "recall", "f1", "top1", "top3"))


def _series(name: str, lists: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY k) AS row_no, k AS source, '{name}' AS series, *
FROM {_metrics(lists, "media")}"""


ORACLES = {
    "coverage_by_day": _coverage("day"),
    "coverage_by_week": _coverage("week"),
    "coverage_by_month": _coverage("month"),
    "coverage_incremental": _coverage("day"),
    "stored_texts": """SELECT source AS media, count(*) AS n, sum(length(text))::BIGINT AS chars, 2 AS kinds FROM documents GROUP BY 1""",
    "stored_articles": f"""WITH {ARTICLES} SELECT media, count(*) AS n, sum(label)::BIGINT AS on_topic FROM articles
WHERE date BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' GROUP BY 1""",
    "kpi_summary": f"""WITH {ARTICLES}, newest AS (SELECT max(date) AS day FROM articles), spans AS (
SELECT count(*) AS n, avg(label) * 100 AS share,
       avg(label) FILTER (WHERE date > day - INTERVAL 7 DAY) AS short,
       avg(label) FILTER (WHERE date > day - INTERVAL 30 DAY) AS long, min(date) AS low, max(date) AS high
FROM articles, newest)
SELECT n AS total_articles, round(share, 6) AS share, share > 10 AS above_threshold,
       round((short - long) * 100, 6) AS evolution, short - long > 0 AS rising,
       CAST(low AS STRING) AS first_date, CAST(high AS STRING) AS last_date FROM spans""",
    "selection_share": f"""WITH {ARTICLES}
SELECT round(avg(label) * 100, 6) AS share, avg(label) * 100 > 10 AS above_threshold FROM articles
WHERE date BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND media = 'media1'""",
    "filter_values": f"""SELECT DISTINCT 'media' AS filter, source AS value, 0 AS rank FROM documents
UNION ALL SELECT DISTINCT 'month', {_match(map(str, range(1, 13)), FRENCH_MONTHS, "CAST(month(d) AS STRING)")}, CAST(month(d) AS INT)
FROM (SELECT DATE '2024-01-01' + CAST(doc_id % 366 AS INT) AS d FROM documents)""",
    "parse_mixed_dates": f"""WITH {ARTICLES}
SELECT article_id, label,
       strftime(CASE article_id % 8 WHEN 1 THEN date_trunc('second', date) WHEN 3 THEN NULL ELSE date_trunc('day', date) END,
                '%Y-%m-%d %H:%M:%S') AS date
FROM articles""",
    "date_parts": f"""WITH {ARTICLES}
SELECT article_id, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day,
       CAST(try_cast(split_part(raw_date, ' ', 1) AS DATE) AS STRING) AS date_part,
       CAST(CAST(date_trunc('month', date) AS DATE) AS STRING) AS month_start,
       strftime(date, '%b %Y') AS month_label, strftime(date, '%Y-%m') AS month_key,
       {_list(FRENCH_MONTHS)}[CAST(month(date) AS INT)] AS month_name
FROM articles""",
    "null_text_report": f"""WITH {GAPPY}
SELECT count(*) AS rows, count(*) - count(quality) AS null_texts FROM gappy""",
    "drop_empty_text": f"WITH {GAPPY} SELECT doc_id, text, quality FROM gappy WHERE quality IS NOT NULL",
    "per_date_counts": f"""WITH {ARTICLES}
SELECT article_id, CAST(CAST(date AS DATE) AS STRING) AS date, label,
       count(*) OVER (PARTITION BY CAST(date AS DATE)) AS number_articles,
       CAST(sum(label) OVER (PARTITION BY CAST(date AS DATE)) AS BIGINT) AS number_climate
FROM articles""",
    "outlet_daily_share": f"""WITH {ARTICLES}
SELECT media, CAST(date AS STRING) AS date, round(avg(label), 6) AS label,
       round(avg(CASE WHEN label = 1 THEN 1 ELSE 0 END), 6) AS selected
FROM articles GROUP BY media, articles.date""",
    "rolling_share": _rolling("PARTITION BY media"),
    "rolling_share_legacy": _rolling(""),
    "outlet_colours": f"""WITH {ARTICLES}
SELECT article_id, media, {_match(Q.COLOURS, Q.COLOURS.values(), "media")} AS colour FROM articles""",
    "confidence_stats": f"""WITH {ARTICLES}
SELECT round(avg(confidence), 6) AS avg_confidence, round(stddev_samp(confidence), 6) AS std_confidence
FROM articles WHERE label = 1""",
    "rolling_confidence": f"""WITH {ARTICLES}, rolled AS (
SELECT article_id, count(*) OVER w AS n, avg(confidence) OVER w AS a, stddev_samp(confidence) OVER w AS s
FROM articles WHERE label = 1
WINDOW w AS (ORDER BY date, article_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT article_id, CASE WHEN n = 10 THEN round(a, 6) END AS avg_proba, CASE WHEN n = 10 THEN round(s, 6) END AS std_proba
FROM rolled""",
    "explorer_filtered": f"""WITH {EXPLORER}
SELECT doc_id, CAST(date AS STRING) AS date, media, label_1, label_2, label_3,
       prediction_label_1, prediction_label_2, prediction_label_3
FROM shown WHERE month(date) = {_MARCH} AND (coalesce(prediction_label_1 IN {_in(Q.SELECTION)}, FALSE)
  OR coalesce(prediction_label_2 IN {_in(Q.SELECTION)}, FALSE) OR coalesce(prediction_label_3 IN {_in(Q.SELECTION)}, FALSE))""",
    "explorer_page": f"""WITH {EXPLORER}
SELECT doc_id, CAST(date AS STRING) AS date, media, label_1, label_2, label_3,
       prediction_label_1, prediction_label_2, prediction_label_3
FROM (SELECT * FROM shown ORDER BY date, doc_id LIMIT 100 OFFSET 100)""",
    "explorer_page_sorted": f"""WITH {EXPLORER}
SELECT doc_id, CAST(date AS STRING) AS date, media, label_1, label_2, label_3,
       prediction_label_1, prediction_label_2, prediction_label_3
FROM (SELECT * FROM shown ORDER BY date, doc_id LIMIT 100 OFFSET 100)""",
    "explorer_index_info": f"""WITH {EXPLORER}
SELECT count(*) AS total_rows, greatest(CAST(ceil(count(*) / 100) AS BIGINT), 1) AS total_pages FROM shown""",
    "explorer_page_info": f"""WITH {EXPLORER}
SELECT count(*) AS total_rows, greatest(CAST(ceil(count(*) / 100) AS BIGINT), 1) AS total_pages FROM shown""",
    "category_counts": _counts(explorer_codes()) + " SELECT category, n FROM counts",
    "category_counts_legacy": _counts(explorer_codes(legacy=True)) + " SELECT category, n FROM counts",
    "category_counts_macro": _counts(sorted(MACRO_CODES), macro=True) + " SELECT category, n FROM counts",
    "macro_explorer": f"""WITH {MACRO}
SELECT doc_id, CAST(date AS STRING) AS date, media, label_1, label_2, label_3, prediction_label_1 FROM shown_macro""",
    "macro_metrics": f"""WITH {MACRO}
SELECT precision, recall, f1, top1, top3 FROM {_metrics("macro_lists", "1", codes=MACRO_CODES)}""",
    "explorer_columns": f"""WITH {PREDICTIONS}
SELECT doc_id, media, label_1, label_2, prediction_label_1, prediction_label_2, prediction_label_3 FROM predictions""",
    "category_share": _counts(explorer_codes())
    + " SELECT category, n, round(n * 100e0 / sum(n) OVER (), 1) AS percent FROM counts",
    "category_share_legacy": _counts(explorer_codes(legacy=True))
    + " SELECT category, n, round(n * 100e0 / sum(n) OVER (), 1) AS percent FROM counts",
    "category_by_month": f"""WITH {EXPLORER}
SELECT strftime(date, '%b %Y') AS month, category, count(*) AS n FROM long
WHERE category IN (SELECT DISTINCT category FROM long WHERE category IS NOT NULL ORDER BY 1 LIMIT 3)
GROUP BY 1, 2""",
    "category_by_month_selected": f"""WITH {EXPLORER}
SELECT strftime(date, '%b %Y') AS month, category, count(*) AS n FROM long WHERE category IN {_in(Q.SELECTION)} GROUP BY 1, 2""",
    "themes_by_month": f"""WITH {EXPLORER}, themed AS (
SELECT DISTINCT doc_id, date, {_theme("category")} AS theme FROM long WHERE doc_id % 19 <> 0)
SELECT strftime(date, '%Y-%m') AS month, theme, count(*) AS n FROM themed WHERE theme IS NOT NULL GROUP BY 1, 2""",
    "themes_by_month_legacy": f"""WITH {EXPLORER}, themed AS (
SELECT DISTINCT doc_id, CASE WHEN doc_id % 19 = 0 THEN 'NaT' ELSE strftime(date, '%Y-%m') END AS month,
       {_theme("category")} AS theme FROM long)
SELECT month, theme, count(*) AS n FROM themed WHERE theme IS NOT NULL GROUP BY 1, 2""",
    "parse_answers": f"""WITH {BLOCKS}
SELECT conv_id, turn, block, readable,
       CASE WHEN readable THEN array_to_string(list_sort(json_keys(block)), ',') END AS keys FROM checked""",
    "answer_classes": f"""WITH {BLOCKS}, classes AS (SELECT conv_id, turn, {_PLACEHOLDER} FROM checked WHERE readable)
SELECT * FROM classes
WHERE prediction_label_1 IS NOT NULL AND prediction_label_2 IS NOT NULL AND prediction_label_3 IS NOT NULL""",
    "api_answers": f"""WITH {RESPONSES}, first AS (
SELECT conv_id, turn, concat('{{', regexp_extract(bare, '\\{{([^}}]*)', 1), '}}') AS block FROM responses)
SELECT conv_id, turn, block, json_valid(block) AS readable FROM first""",
    "repr_answers": f"""WITH {RESPONSES}
SELECT conv_id, turn, one AS prediction_label_1, two AS prediction_label_2,
       CASE kind WHEN 4 THEN NULL WHEN 1 THEN '[None, None]' WHEN 2 THEN 'true' ELSE 'Pollution' END AS prediction_label_3
FROM responses WHERE kind <> 3""",
    "normalised_labels": f"""WITH {LISTS}
SELECT doc_id, array_to_string(truth, '|') AS truth, array_to_string(predicted, '|') AS predicted FROM lists""",
    "compacted_labels": f"""WITH {PREDICTIONS}
SELECT doc_id, concat_ws('|', label_1, label_2, label_3) AS truth,
       concat_ws('|', prediction_label_1, prediction_label_2, prediction_label_3) AS predicted FROM predictions""",
    "label_indicator": f"""WITH {LISTS}
SELECT doc_id, {", ".join(f"CAST(list_contains(truth, {_q(c)}) AS INT) AS {c}" for c in METRIC_CODES)} FROM lists""",
    "label_counts": f"""WITH {LISTS}, named AS (
SELECT l.label, list_contains(truth, l.label) AS t, list_contains(predicted, l.label) AS p
FROM lists, (SELECT unnest({_list(METRIC_CODES)}) AS label) l)
SELECT label, count(*) FILTER (WHERE t AND p) AS hit, count(*) FILTER (WHERE p) AS predicted,
       count(*) FILTER (WHERE t) AS actual FROM named WHERE t OR p GROUP BY 1""",
    "multilabel_metrics": f"WITH {LISTS} SELECT * EXCLUDE (k) FROM {_metrics('lists', '1')}",
    "multilabel_metrics_any_rank": f"WITH {LISTS} SELECT * EXCLUDE (k) FROM {_metrics('lists', '1', top='len(predicted)')}",
    "hallucinations": f"""WITH {PREDICTIONS}
SELECT count(*) FILTER (WHERE {" OR ".join(
    f"(prediction_label_{i} IS NOT NULL AND {_code(f'prediction_label_{i}')} IS NULL "
    f"AND prediction_label_{i} NOT IN {_in([*METRIC_CODES, MISSING_KEY_MICRO])})" for i in (1, 2, 3)
)}) AS hallucinations
FROM predictions""",
    "hallucinations_legacy": f"""WITH {LISTS}
SELECT count(*) FILTER (WHERE list_contains(predicted, 'N/A')) AS hallucinations FROM lists""",
    "metrics_by_run": f"""WITH {LISTS}, runs AS (SELECT *, concat('modela_', {_RUN}) AS source FROM lists)
SELECT k AS source, * EXCLUDE (k) FROM {_metrics("runs", "source")}
UNION ALL SELECT * FROM {_values([PUBLISHED_RUN], "source, precision, recall, f1, top1, top3, unsure")}""",
    "run_manifest": f"""SELECT DISTINCT concat('./runs/articles_modela_', {_RUN}, '.csv') AS path,
       concat('modela_', {_RUN}) AS source FROM documents""",
    "confusion": f"""WITH {SCORED}
SELECT label AS actual, count(*) FILTER (WHERE predicted = 0) AS predicted_0,
       count(*) FILTER (WHERE predicted = 1) AS predicted_1 FROM scored GROUP BY 1""",
    "class_report": f"""WITH {SCORED}, classes AS (
SELECT CAST(c AS STRING) AS class, count(*) FILTER (WHERE label = c AND predicted = c) AS hit,
       count(*) FILTER (WHERE predicted = c) AS guessed, count(*) FILTER (WHERE label = c) AS support
FROM scored, (SELECT unnest([0, 1]) AS c) GROUP BY c),
rates AS (SELECT class, coalesce(hit / nullif(guessed, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r,
       coalesce(2e0 * hit / nullif(guessed + support, 0), 0) AS f, support, hit FROM classes)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM rates
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
       round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rates
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM rates
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
       round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rates""",
    "class_weights": f"""WITH {ARTICLES}
SELECT label, count(*) AS n, round((SELECT count(*) FROM articles) /
       ((SELECT count(DISTINCT label) FROM articles) * count(*)), 6) AS weight FROM articles GROUP BY 1""",
    "accuracy_logloss": f"""WITH {SCORED}, chances AS (
SELECT label, predicted, CASE WHEN label = 1 THEN 2.5e0 ELSE 0.625e0 END AS w,
       least(greatest(CASE WHEN label = predicted THEN confidence ELSE 1 - confidence END, 1e-7), 1 - 1e-7) AS p
FROM scored)
SELECT round(avg(CASE WHEN label = predicted THEN 1 ELSE 0 END), 6) AS accuracy,
       round(sum(-w * ln(p)) / sum(w), 6) AS logloss FROM chances""",
    "split_sizes": """WITH sizes AS (
SELECT l.quality AS label, count(*) AS n FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1),
cuts AS (SELECT label, n, CAST(round(n * (1 - 0.3e0)) AS BIGINT) AS a, CAST(round(n * (1 - 0.3e0 / 2)) AS BIGINT) AS b FROM sizes)
SELECT 'train' AS split, label, a AS n FROM cuts WHERE a > 0
UNION ALL SELECT 'val', label, b - a FROM cuts WHERE b > a
UNION ALL SELECT 'test', label, n - b FROM cuts WHERE n > b""",
    "stored_splits": """WITH sizes AS (
SELECT l.quality AS label, count(*) AS n FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1),
cuts AS (SELECT label, n, CAST(round(n * (1 - 0.3e0)) AS BIGINT) AS a, CAST(round(n * (1 - 0.3e0 / 2)) AS BIGINT) AS b FROM sizes)
SELECT 'train' AS split, label, a AS n FROM cuts WHERE a > 0
UNION ALL SELECT 'val', label, b - a FROM cuts WHERE b > a
UNION ALL SELECT 'test', label, n - b FROM cuts WHERE n > b""",
    "stored_metrics": f"""WITH {LISTS}, runs AS (SELECT *, concat('modela_', {_RUN}) AS source FROM lists)
SELECT k AS source, 2 AS copies, f1 FROM {_metrics("runs", "source")}
UNION ALL SELECT source, 2, f1 FROM {_values([PUBLISHED_RUN], "source, precision, recall, f1, top1, top3, unsure")}""",
    "detector_invariants": """SELECT DISTINCT quality AS actual, TRUE AS row_sums, TRUE AS diagonals, TRUE AS recalls, TRUE AS supports FROM labels
UNION ALL SELECT NULL, TRUE, TRUE, TRUE, TRUE""",
    "split_total": "SELECT count(*) AS len_dataset FROM documents d JOIN labels l ON l.doc_id = d.doc_id",
    "head_rows": "SELECT doc_id, source AS media FROM documents ORDER BY doc_id LIMIT 400",
    "head_share": """SELECT doc_id, source AS media FROM documents
QUALIFY row_number() OVER (ORDER BY doc_id) <= floor(0.8e0 * count(*) OVER ())""",
    "tail_share": """SELECT doc_id, source AS media FROM documents
QUALIFY row_number() OVER (ORDER BY doc_id DESC) <= floor(0.2e0 * count(*) OVER ())""",
    "clean_tokens": f"""WITH {CLEAN}
SELECT doc_id, len(words) AS n_words, array_to_string(words, ' ') AS words FROM clean""",
    "chunk_text": """WITH numbered AS (
SELECT doc_id, text, unnest(range(CASE WHEN length(text) >= 4999 THEN length(text) // 4999 + 1 ELSE 1 END)) AS chunk_no
FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, substr(text, chunk_no * 4999 + 1, 4999) AS chunk FROM numbered""",
    "topic_tags": rf"""WITH found AS (
SELECT doc_id, regexp_extract_all({_normalised("text")}, '[\p{{L}}\p{{N}}]+') AS words FROM documents),
phrases AS (
SELECT doc_id, unnest(words) AS phrase FROM found
UNION SELECT doc_id, unnest([concat(words[i], ' ', words[i + 1]) for i in range(1, len(words))]) FROM found),
hits AS (
SELECT doc_id, theme, subtheme, count(DISTINCT phrase) AS terms
FROM phrases JOIN {_values([(a, b, T.normalise_word(c)) for a, b, c in Q.LEXICON], "theme, subtheme, term")} x ON phrase = x.term
GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY terms DESC, subtheme, theme) AS rank FROM hits)
SELECT doc_id, CAST(rank AS INT) AS rank, theme, subtheme, CAST(terms AS INT) AS terms FROM ranked WHERE rank <= 3""",
    "lexicon_topics": rf"""WITH found AS (
SELECT doc_id, regexp_extract_all({_normalised("text")}, '[\p{{L}}\p{{N}}]+') AS words FROM documents),
singles AS (SELECT doc_id, unnest(words) AS phrase FROM found),
doubles AS (SELECT doc_id, unnest([concat(words[i], ' ', words[i + 1]) for i in range(1, len(words))]) AS phrase FROM found),
terms AS (
SELECT phrase, row_number() OVER (ORDER BY count(*) DESC, phrase) - 1 AS n FROM singles WHERE length(phrase) > 3 GROUP BY 1
QUALIFY n < {Q.LEXICON_WORDS}
UNION ALL SELECT phrase, row_number() OVER (ORDER BY count(*) DESC, phrase) - 1 AS n FROM doubles GROUP BY 1 QUALIFY n < {Q.LEXICON_PAIRS}),
lexicon AS (SELECT phrase, concat('topic_', n % {Q.LEXICON_TOPICS}) AS subtheme,
                   list_extract({_list(THEMES)}, CAST(n % {Q.LEXICON_TOPICS} % {len(THEMES)} + 1 AS INT)) AS theme FROM terms),
hits AS (
SELECT doc_id, theme, subtheme, count(DISTINCT phrase) AS terms
FROM (SELECT * FROM singles UNION ALL SELECT * FROM doubles) JOIN lexicon USING (phrase) GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY terms DESC, subtheme, theme) AS rank FROM hits)
SELECT doc_id, CAST(rank AS INT) AS rank, theme, subtheme, CAST(terms AS INT) AS terms FROM ranked WHERE rank <= 3""",
    "seeded_topic_checks": "SELECT lang, TRUE AS recognised, TRUE AS beyond_seeds FROM documents WHERE n_chars >= 200 GROUP BY lang",
    "salient_words": f"""WITH {SALIENT}
SELECT doc_id, word, weight, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 3""",
    "detector_checks": f"""WITH {SALIENT}
SELECT doc_id, TRUE AS decided, TRUE AS bounded, string_agg(word, ' ' ORDER BY rank) AS top_words
FROM (SELECT doc_id, word, rank FROM ranked WHERE rank <= 3 UNION ALL
      SELECT doc_id, NULL, 0 FROM documents WHERE text IS NOT NULL) GROUP BY 1""",
    "detector_reasons": "SELECT doc_id, TRUE AS adds_up, TRUE AS decides, TRUE AS short FROM documents WHERE text IS NOT NULL",
    "category_checks": """SELECT doc_id, TRUE AS named, TRUE AS "distinct", TRUE AS known, TRUE AS ranked FROM documents""",
    "prompt_table": f"""SELECT doc_id, {_around(P.USER_PROMPT, "text")} AS user_message, model, prompt_method, n_shots, system_message
FROM documents, {_values(_GRID, "model, prompt_method, n_shots, system_message")}""",
    "task_prompts": f"""SELECT doc_id, {_around(P.fill(P.MICRO_PROMPT, DISPLAY_NAMES, answer=_SPACED), "text")} AS micro,
       {_around(P.fill(P.MACRO_PROMPT, MACRO_CODES, answer='{ "Classe_1": "categorie"}'), "text")} AS macro,
       concat({_q(P.fill(P.SINGLE_LABEL_PROMPT, DISPLAY_NAMES))}, chr(10), {_around(P.USER_PROMPT, "text")}) AS single
FROM documents""",
    "training_table": f"""WITH {PREDICTIONS}
SELECT doc_id, concat({_around(P.fill(P.TRAINING_PROMPT, DISPLAY_NAMES, answer=_SPACED), "description")}, {_ANSWER}) AS training_text
FROM predictions""",
    "batch_scores": f"SELECT doc_id, {_name('length(text)')} AS prediction_label_1 FROM documents",
    "refined_scores": f"""WITH first AS (
SELECT doc_id, text, concat('{{"Classe_1": "', {_name(f"{_MESSAGE} + 1 + length(text)")}, '"}}') AS block FROM documents)
SELECT doc_id, {_name(f"{_MESSAGE} + 1 + length(block) + 1 + length(text)")} AS prediction_label_1 FROM first""",
    "metric_comparison": f"""WITH {LISTS}, firsts AS (SELECT doc_id, media, truth, predicted[1:1] AS predicted FROM lists),
series AS ({_series("three", "lists")} UNION ALL {_series("first", "firsts")})
SELECT row_no, source, metric, series,
       CASE metric WHEN 'precision' THEN precision WHEN 'recall' THEN recall WHEN 'f1' THEN f1
                   WHEN 'top1' THEN top1 ELSE top3 END AS value
FROM series, (VALUES {_COMPARED}) AS m(metric)""",
    "size_energy": f"""WITH {ARTICLES}, counts AS (
SELECT media, strftime(date, '%Y-%m') AS month, count(*) AS articles FROM articles WHERE label = 1 GROUP BY 1, 2)
SELECT media, month, articles, model, size_b, wh_per_1000, open_source, round(log10(size_b), 6) AS log_size,
       round(log10(wh_per_1000), 6) AS log_energy, round(wh_per_1000 * articles / 1000, 6) AS corpus_wh
FROM counts, {_values(MODEL_ENERGY, "model, size_b, wh_per_1000, open_source")} WHERE size_b IS NOT NULL""",
    "dedupe_columns": f"WITH {ARTICLES} SELECT article_id, media, label, raw_date FROM articles",
}
