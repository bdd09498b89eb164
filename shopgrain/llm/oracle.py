"""SQL for the queries that SQL can express, written apart from the Spark jobs."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _secrets() -> str:
    names = "|".join([*map(_either, ("password", "passwd", "secret", "token")),
                      _either("api") + "_?" + _either("key")])
    assign = rf"({names})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
    kinds = [("assign", assign, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16),
             ("hex", "[0-9a-f]+", 0, 32),
             ("github", "gh[pousr]_[A-Za-z0-9]{36,255}", 0, 1),
             ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1),
             ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1)]
    each = " UNION ALL ".join(
        f"SELECT doc_id, '{kind}' AS kind, {i} AS ord, {least} AS least, "
        f"string_split_regex(t, '{regex}') AS gap, regexp_extract_all(t, '{regex}', 0) AS whole, "
        f"regexp_extract_all(t, '{regex}', {group}) AS part FROM d"
        for i, (kind, regex, group, least) in enumerate(kinds))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({each}),
n AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, kind, ord, length(whole[i]) AS size,
    length(array_to_string(gap[1:i], '')) + length(array_to_string(whole[1:i - 1], '')) AS start
  FROM n WHERE length(part[i]) >= least),
g AS (
  SELECT doc_id, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access,
    count_if(kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, ord)
      FILTER (WHERE ord < 3) AS base,
    string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, ord) AS spans
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS c FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.c, d.c)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10"""


def _mixing(rounds: int = 6, power: float = 0.7) -> str:
    dimensions = ("source", "lang", "topic")
    steps = [f"""
d AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n_words,
    CASE WHEN contains(text, ' | ') THEN 'table'
      WHEN regexp_matches(text, '[#*$%&]{{3}}') THEN 'markup'
      WHEN contains(text, '!!') THEN 'shout'
      WHEN length(coalesce(text, '')) < 500 THEN 'short' ELSE 'prose' END AS topic
  FROM documents),
cells AS (
  SELECT source, lang, topic, sum(n_words)::DOUBLE AS weight FROM d
  GROUP BY source, lang, topic HAVING sum(n_words) > 0),
f0 AS (SELECT *, weight AS w FROM cells)"""]
    for x in dimensions:
        steps.append(f"""
t_{x} AS (
  SELECT {x}, pow(w, {power}) / sum(pow(w, {power})) OVER () AS target
  FROM (SELECT {x}, sum(weight) AS w FROM cells GROUP BY {x}))""")
    k = 0
    for _ in range(rounds):
        for x in dimensions:
            k += 1
            steps.append(f"""
f{k} AS MATERIALIZED (
  SELECT f.source, f.lang, f.topic, f.weight,
    f.w * t.target * (SELECT sum(weight) FROM cells) / sum(f.w) OVER (PARTITION BY f.{x}) AS w
  FROM f{k - 1} f JOIN t_{x} t ON f.{x} IS NOT DISTINCT FROM t.{x})""")
    return "WITH " + ",".join(steps) + f""",
p AS (SELECT *, w / weight / max(w / weight) OVER () AS inclusion FROM f{k})
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_words::BIGINT AS n_words,
  round(inclusion, 6) AS inclusion
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang
  AND d.topic = p.topic
WHERE ('0x' || left(md5('mix' || doc_id::VARCHAR), 12))::BIGINT / pow(2, 48) < inclusion"""


QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '{_WORD}') GROUP BY doc_id),
f AS (
  SELECT d.doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g')) AS letters,
    length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS capitals,
    length(t) - length(replace(t, '!', '')) AS calls
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 10 > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_dup_lines * 2 > n_lines
    OR capitals * 2 > letters OR calls * 10 > n_words OR letters * 2 < word_chars) AS kept
FROM b"""

TOKEN_COUNTS = f"""
SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'),
  lambda x: x <> ''))::BIGINT AS n_tokens
FROM documents"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
    list_dot_product(a.c, d.c)::BIGINT AS score
  FROM v a JOIN v d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (
      PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10"""


SHARDING = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
b AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    list_transform(list_filter(string_split(regexp_replace(hex(encode(coalesce(text, ''))),
      '(..)', '\1 ', 'g'), ' '), lambda x: x <> ''), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
d AS (
  SELECT doc_id, source, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) AS text_crc32
  FROM b, crc),
r AS (
  SELECT *, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY ('0x' || left(md5(concat_ws('|', 'shard',
      doc_id, source, size, text_crc32)), 15))::BIGINT, doc_id NULLS FIRST, size, text_crc32) - 1
      AS i,
    ('0x' || left(md5(concat_ws('|', 'shard', 'phase', source)), 15))::BIGINT::DOUBLE
      / pow(2, 60) AS phase
  FROM d),
p AS (
  SELECT *, count(*) OVER () AS total,
    row_number() OVER (ORDER BY (i + phase) / n, source NULLS FIRST) - 1 AS place FROM r)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
  (place * 16 // total)::INTEGER AS shard, NULL::INTEGER AS grown_shard, source,
  row_number() OVER (PARTITION BY place * 16 // total ORDER BY place) - 1 AS slot
FROM p"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secrets": _secrets(),
        "op2_top_k": TOP_K,
        "op3_mixing": _mixing(),
        "op7_quality": QUALITY,
        "op8_token_counts": TOKEN_COUNTS,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_sharding": SHARDING,
    }
