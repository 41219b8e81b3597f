"""The quality-rule query in DuckDB's SQL, line by line from its contract and its rules."""

WORDS = r"list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
#: The phrases of hearthline.llm.quality_rules.
PHRASES = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "click here",
    "enable javascript", "lorem ipsum", "subscribe to our newsletter",
)
BOILER = " OR ".join(f"contains(lower(l), '{p}')" for p in PHRASES)
BLANK = r"regexp_full_match(l, '[\x20\x09-\x0D]*')"
BAD = rf"""(
    (NOT regexp_matches(l, '[.!?…。！？]') AND length(l) >= 50)
    OR len(regexp_extract_all(l, '[#*$%&|<>]')) * 20 > length(l)
    OR (length(l) - length(replace(l, '!!', ''))) * 20 > length(l)
    OR (NOT regexp_matches(l, '[.!?…。！？]') AND length(l) <= 30
        AND regexp_matches(l, '^[\x20\x09-\x0D]*(home|menu|next|previous|back|login|log in|share|search|skip to content)\b', 'i'))
    OR {BOILER})"""
OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, doc_id, x, {WORDS} AS ws FROM d),
win AS (SELECT r, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w),
tri AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM win),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE n > 1) GROUP BY r),
cut AS (SELECT r, unnest(string_split(x, chr(10))) AS l FROM d),
line AS (
    SELECT r, count(*) FILTER (NOT {BLANK}) - count(DISTINCT l) FILTER (NOT {BLANK}) AS n_dup_lines,
        count(*) FILTER (NOT {BLANK} AND {BAD}) AS n_failed_lines, count(*) AS n_lines,
        coalesce(sum(length(l)) FILTER ({BLANK} OR NOT {BAD}), 0) + greatest(count(*) FILTER ({BLANK} OR NOT {BAD}) - 1, 0) AS left_chars
    FROM cut GROUP BY r),
base AS (
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(n_failed_lines AS BIGINT) AS n_failed_lines,
        CAST(length(x) - left_chars AS BIGINT) AS lost_chars, length(x) AS chars
    FROM w JOIN line USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5 * chars AS kept, n_failed_lines, lost_chars
FROM base
"""
