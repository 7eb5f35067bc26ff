"""SQL that states the same rows as the queries, where SQL can."""

from __future__ import annotations

from .hard_negatives import ANCHOR_EVERY, LEAST, MOST, NEGATIVES, POSITIVES, SCALE
from .mixing import MARGINS, MOST_ROUNDS, POWERS, SHARE
from .warc import LEAST_PAYLOAD

WARC = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p
  WHERE payload_bytes >= {LEAST_PAYLOAD} GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id IS DISTINCT FROM f.first AND f.first IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

def _mixing() -> str:
    """Raking in so many rounds, one common table for each scaling, then the calibration."""
    parts = [
        r"""
d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
              WHEN contains(coalesce(text, ''), '@') THEN 'contact'
              WHEN contains(coalesce(text, ''), 'icense') THEN 'licence'
              ELSE 'prose' END AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS BIGINT)
           AS n_tokens,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13) AS BIGINT)
           / 4503599627370496.0 AS draw
  FROM documents)""",
        "c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n"
        " FROM d GROUP BY ALL)",
    ]
    for m in MARGINS:
        parts.append(
            f"t_{m} AS MATERIALIZED (SELECT {m}, pow(sum(n), {POWERS[m]}) AS raised FROM c GROUP BY {m})"
        )
        parts.append(
            f"g_{m} AS MATERIALIZED (SELECT {m}, raised / (SELECT sum(raised) FROM t_{m}) AS target"
            f" FROM t_{m})"
        )
    parts.append("w_0 AS MATERIALIZED (SELECT source, lang, topic, n, n AS weight FROM c)")
    step = 0
    for _ in range(MOST_ROUNDS):
        for m in MARGINS:
            parts.append(
                f"w_{step + 1} AS MATERIALIZED (SELECT source, lang, topic, n, weight * target /"
                f" sum(weight) OVER (PARTITION BY {m}) AS weight FROM w_{step} JOIN g_{m} USING ({m}))"
            )
            step += 1
    parts.append(
        f"""
r AS MATERIALIZED (
  SELECT *, weight / n AS per_token,
         sum(n) OVER up AS n_up, sum(weight) OVER up AS weight_up,
         sum(n) OVER () AS n_all, sum(weight) OVER () AS weight_all
  FROM w_{step}
  WINDOW up AS (ORDER BY weight / n DESC, source, lang, topic
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (
  SELECT *, ({SHARE} * n_all - (n_up - n)) / (weight_all - weight_up + weight) AS scale,
         row_number() OVER (ORDER BY per_token DESC, source, lang, topic) AS place FROM r),
-- the first cell that is not whole, if all before it are, sets the scale of it and the rest
s AS (
  SELECT arg_min(scale, place) AS scale FROM k WHERE scale * per_token <= 1)"""
    )
    return f"""
WITH {", ".join(parts)}
SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS cell_weight,
       round(least(1.0, per_token * scale), 6) AS probability,
       draw < least(1.0, per_token * scale) AS sampled
FROM d JOIN r USING (source, lang, topic), s
"""


MIXING = _mixing()

SUBSTRINGS = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), w AS MATERIALIZED (
  SELECT doc_id, s, md5(array_to_string(words[s:s + 19], ' ')) AS path
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM d)
), again AS (
  SELECT doc_id, s FROM w
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY doc_id NULLS LAST, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, s + i AS place FROM again, range(0, 20) AS r(i)
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d
), left_over AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.place) AS kept, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.place = g.place
  GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""


HARD_NEGATIVES = f"""
WITH e AS (
  SELECT row_number() OVER (ORDER BY vec_id, label, embedding) AS uid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.uid AS a, a.vec_id AS anchor_id, a.label = b.label AS alike,
         b.uid AS b, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.uid <> b.uid WHERE a.vec_id % {ANCHOR_EVERY} = 0
), p AS (
  SELECT a, anchor_id, b, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, vec_id, s.b) AS INTEGER)
         AS rank
FROM p JOIN s ON s.a = p.a
WHERE NOT alike AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
QUALIFY rank <= {NEGATIVES}
"""


def _repair() -> str:
    """Damage by a bitwise CRC-32, the best way to each state row by row, then the letters walked."""
    then = lambda way, cost, letter: (  # noqa: E731
        f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}'}} END"
    )
    if_kept = lambda test, way: f"CASE WHEN NOT bad AND {test} THEN {way} END"  # noqa: E731
    keep = lambda way, initial: if_kept(f"initial = '{initial}'", then(way, "cut", "K"))  # noqa: E731
    rerole = lambda way: if_kept("TRUE", then(way, "2 + cut", "R"))  # noqa: E731
    least = lambda *ways: f"least({', '.join(ways)})"  # noqa: E731
    delete = lambda way: then(way, 3, "D")  # noqa: E731
    insert = lambda way: then(way, 2, "I")  # noqa: E731
    twice = lambda way: then(way, 4, "II")  # noqa: E731
    to_user = [f(w) for w in ("q0", "q1", "q3") for f in (lambda w: keep(w, "u"), rerole)]
    return rf"""
WITH RECURSIVE r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
             || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda s: CAST(ascii(s) AS BIGINT)),
           lambda crc, b: list_reduce(CAST(range(8) AS BIGINT[]),
             lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
           CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS draw
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) FROM r WHERE draw <> 0)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS n FROM d
), f AS (
  SELECT conv_id, turn, n, role, text, substr(role, 1, 1) AS initial,
         NOT regexp_matches(text, '[^ 	-]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
         NOT regexp_matches(text, '[.!?][ 	-]*$') AS unended
  FROM o
), m AS (
  SELECT *, blank OR again AS bad, CAST(unended AND NOT blank AND NOT again AS INT) AS cut,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial
           NOT IN ('su', 'ua', 'au'), FALSE) AS unlike
  FROM f
), s AS (
  SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
         count(*) FILTER (WHERE cut = 1) AS truncated, count(*) FILTER (WHERE unlike) AS illegal,
         count(n) AS size
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id
), w AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': 0, 'a': ''}} AS q0,
         CAST(NULL AS STRUCT(c INT, a VARCHAR)) AS q1, {{'c': 2, 'a': 'I'}} AS q2, {{'c': 4, 'a': 'II'}} AS q3
  FROM s
  UNION ALL
  SELECT conv_id, n, q0, q1, {least("q2", insert("q0"), insert("q1"), insert("q3"))},
         {least("q3", insert("q2"), twice("q0"), twice("q1"))}
  FROM (
    SELECT w.conv_id, m.n, {delete("q0")} AS q0, {least(delete("q1"), keep("q0", "s"))} AS q1,
           {least(delete("q2"), *to_user)} AS q2, {least(delete("q3"), keep("q2", "a"), rerole("q2"))} AS q3
    FROM w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.n + 1)
), b AS (
  SELECT s.*, least(q0, q3) AS best FROM s
  JOIN w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.n = s.size
), p AS (
  SELECT conv_id, best.a AS audit, 0 AS pos, CAST(0 AS BIGINT) AS n, 0 AS state,
         CAST(NULL AS VARCHAR) AS line FROM b
  UNION ALL
  SELECT p.conv_id, audit, pos + 1, p.n + step,
         CASE WHEN letter = 'D' THEN state WHEN letter = 'K' AND initial = 's' THEN 1
              WHEN state = 2 THEN 3 ELSE 2 END,
         CASE WHEN letter = 'D' THEN NULL
              ELSE CASE WHEN letter = 'K' THEN role WHEN state = 2 THEN 'assistant' ELSE 'user' END
                || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END END
  FROM (SELECT *, substr(audit, pos + 1, 1) AS letter,
               CASE WHEN substr(audit, pos + 1, 1) = 'I' THEN 0 ELSE 1 END AS step
        FROM p WHERE pos < length(audit)) p
  LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.n = p.n + step AND step = 1
)
SELECT b.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(best.c AS BIGINT) AS cost,
       best.a AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM b LEFT JOIN (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM p GROUP BY conv_id
) t ON t.conv_id IS NOT DISTINCT FROM b.conv_id
"""


REPAIR = _repair()
