"""DuckDB SQL equal to the registered queries that SQL can express.

Not among them: queries on tokenizers' ids (2, 8, 9, 10, 12), the suffix tree's
scores (5), approximate neighbours (6), language identification (1), sentence
spans by hash (4) and the fitted classifier (11); tests hold these against
plain versions.
"""

from __future__ import annotations

from clickpulse.llm.quality import ERROR, LEVELS, MAX_FALSE_REJECTION, MIN_WORDS, RULES

WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def jaccard_components(k: int, num: int, den: int) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    window = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""WITH RECURSIVE worded AS (
  SELECT doc_id, {WORDS} AS w
  FROM (SELECT doc_id, translate(COALESCE(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents)
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: {window})
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS s
  FROM worded
),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM tokens a JOIN tokens b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING {den} * COUNT(*) >= {num} * (MAX(a.n) + MAX(b.n) - COUNT(*))
),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, LEAST(s.doc_id, COALESCE(m.y, s.doc_id)) AS component_id
FROM sets s LEFT JOIN (SELECT x, MIN(y) AS y FROM reached GROUP BY x) m ON s.doc_id = m.x"""


def quality() -> str:
    names = list(RULES)
    measure = {
        "symbols_per_word": "n_symbols / CAST(GREATEST(n_words, 1) AS DOUBLE)",
        "upper_case_share": "n_upper / CAST(GREATEST(word_chars, 1) AS DOUBLE)",
        "repeated_words_share": "n_repeat_words / CAST(GREATEST(n_words, 1) AS DOUBLE)",
        "repeated_lines_share": "n_dup_lines / CAST(GREATEST(n_lines, 1) AS DOUBLE)",
        "mean_word_length": "word_chars / CAST(GREATEST(n_words, 1) AS DOUBLE)",
    }

    def level(name: str) -> str:
        lenient, strict = RULES[name]
        step = repr((lenient - strict) / (LEVELS - 1))
        return f"LEAST(GREATEST(FLOOR((CAST({lenient!r} AS DOUBLE) - {measure[name]}) / CAST('{step}' AS DOUBLE)) + 1, 0), {LEVELS})"

    share = MAX_FALSE_REJECTION / len(names)
    levels = ", ".join(f"CAST({level(n)} AS INTEGER)" for n in names)
    return rf"""WITH worded AS (
  SELECT doc_id, lang, t, {WORDS} AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, lang, COALESCE(text, '') AS t FROM documents)
),
windows AS (
  SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 3)
),
repeats AS (
  SELECT doc_id, COUNT(DISTINCT i + j) AS n FROM windows, (VALUES (0), (1), (2)) o(j) WHERE n > 1 GROUP BY doc_id
),
counted AS (
  SELECT d.doc_id, COALESCE(NULLIF(lower(regexp_extract(trim(lang), '^([A-Za-z]{{2,8}})(?:[-_]|$)', 1)), ''), 'other') AS stratum,
         CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines,
         length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper
  FROM worded d LEFT JOIN repeats r ON d.doc_id = r.doc_id
),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, [{levels}] AS levels FROM counted
),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING MAX(quality) = 1),
held AS (
  SELECT stratum, rule, levels[rule] AS level
  FROM judged JOIN good USING (doc_id), range(1, {len(names) + 1}) x(rule) WHERE NOT base_failed
),
strata AS (SELECT stratum FROM held UNION SELECT 'other'),
tried AS (
  SELECT s.stratum, r.rule, v.level, COUNT(*) FILTER (WHERE h.level <= v.level) AS k, COUNT(h.level) AS n
  FROM strata s, range(1, {len(names) + 1}) r(rule), range(0, {LEVELS}) v(level)
  LEFT JOIN held h ON h.stratum = s.stratum AND h.rule = r.rule
  GROUP BY s.stratum, r.rule, v.level
),
tails AS (
  SELECT stratum, rule, level,
         CASE WHEN n = 0 OR k > n * {share!r} THEN 1.0
              ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                   + i * ln({share!r}) + (n - i) * ln(1 - {share!r})))) END AS p
  FROM tried
),
cuts AS (
  SELECT stratum, rule, COALESCE(MIN(level) FILTER (WHERE p > CAST({ERROR!r} AS DOUBLE) / ({len(names)} * (SELECT COUNT(*) FROM strata))), {LEVELS}) - 1 AS cut FROM tails GROUP BY stratum, rule
),
verdicts AS (
  SELECT stratum, list(cut ORDER BY rule) AS cut FROM cuts GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND COALESCE({" AND ".join(f"levels[{i + 1}] > cut[{i + 1}]" for i in range(len(names)))}, true) AS kept
FROM judged LEFT JOIN verdicts USING (stratum)"""



def k_means(k: int, rounds: int, dims: int, scale: int, seed: str) -> str:
    """Plain k-means on integers, a pair of tables a round."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}
)""", f"""parts AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range({dims})) AS d FROM kept)""", f"""c0 AS MATERIALIZED (
  SELECT n AS c, unnest(v) AS y, unnest(range({dims})) AS d
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}' || vec_id) NULLS LAST, v) - 1 AS n FROM kept) WHERE n < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, c, s FROM (
    SELECT r, c, s, row_number() OVER (PARTITION BY r ORDER BY s, c) AS n
    FROM (SELECT r, c, CAST(SUM((x - y) * (x - y)) AS BIGINT) AS s FROM parts JOIN c{i} USING (d) GROUP BY r, c)
  ) WHERE n = 1
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, d, COALESCE((t - ((t % n) + n) % n) // n, y) AS y
  FROM c{i} LEFT JOIN (SELECT c, d, CAST(SUM(x) AS BIGINT) AS t, COUNT(*) AS n FROM parts JOIN a{i} USING (r) GROUP BY c, d) USING (c, d)
)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, a.s AS distance,
       CAST(SUM(a.s) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(SUM(a.s) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN kept k USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON a.c = h.c"""


SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": jaccard_components(3, 90, 100),
    "op7_risk_controlled_quality": quality(),
    "op13_va_file_clustering": k_means(k=8, rounds=10, dims=64, scale=1024, seed="3:"),
}
