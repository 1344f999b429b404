"""SQL that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

from pacefold.llm import chat, decontaminate, mixing

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _shingles(table: str, key: str) -> str:
    """Distinct five-word shingles per row; a shorter text is one shingle."""
    return f"""
SELECT DISTINCT {key}, unnest(
         CASE WHEN len(w) >= 5
              THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
              ELSE [array_to_string(w, ' ')] END) AS shingle
FROM (SELECT {key}, regexp_extract_all(translate(text, {_LETTERS}), '[^\\x20\\x09-\\x0D]+') AS w
      FROM {table} WHERE {key} IS NOT NULL)
WHERE len(w) > 0"""


_CONTAINED = f"""
WITH d AS ({_shingles("documents", "doc_id")}),
i AS ({_shingles("benchmark", "item_id")}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared,
       CAST(count(*) AS double) / n_shingles AS containment
FROM d JOIN i USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) * 100 >= n_shingles * {decontaminate.PERCENT}
"""

_WEIGHTS = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"

# The water level: sources stop in the order of size per weight.
_MIXED = f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS varchar), '')) AS o,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS bigint) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, {mixing.MOST_PASSES} * source_size AS cap,
         {_WEIGHTS}[(row_number() OVER (ORDER BY source NULLS LAST) - 1)
                    % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM sums),
levels AS (
  SELECT *, cap / weight AS fullness,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (
            ORDER BY cap / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
water AS (SELECT arg_min(level, fullness) AS level FROM levels WHERE fullness >= level),
targets AS (
  SELECT source, source_size,
         least(CAST(cap AS double), coalesce((SELECT level FROM water), 0.0) * weight) AS target
  FROM levels),
placed AS (
  SELECT s.*, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
         CAST(round(target) AS bigint) AS goal
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS bigint) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE goal // source_size * size
                 + greatest(0, least(size, goal % source_size - b)) END AS bigint) AS taken
FROM placed
"""


def _escaped(column: str) -> str:
    """Length of a text with one backslash more in each control string."""
    return f"length({column}) + len(regexp_extract_all({column}, '<\\\\*\\|'))"


_CHATS = f"""
WITH turns AS (
  SELECT CAST(conv_id AS bigint) AS conv_id, turn, role AS r, text AS t,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{chat.HOSTILE}', 'user', '{chat.HOSTILE}'
  UNION ALL SELECT -1, 1, 'assistant', '{chat.HOSTILE}', 'assistant', '{chat.HOSTILE}'),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)
                  FILTER (role = '{chat.LEARNT_ROLE}'), '') AS learnt,
         sum({len(chat.START) + len(chat.END) + 2} + {_escaped("role")} + {_escaped("text")}
             + {len(chat.ROLE_FEED) - 1} * (length(role) - length(replace(role, chr(10), ''))))
           AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learnt) AS bigint) AS loss_chars,
       sha256(learnt) AS loss_sha256, CAST(formatted_chars AS bigint) AS formatted_chars
FROM joined
"""


def oracle() -> dict[str, str]:
    return {"op1_decontamination": _CONTAINED, "op4_chat": _CHATS, "op8_mixing": _MIXED}
