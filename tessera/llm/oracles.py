"""SQL of those queries of this package that SQL can express over whole tables.

Tokenizers, estimates and places of pattern matches are beyond it; their queries are tested against plain versions.
"""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"


def _run(length: int) -> str:
    """A word and those after it, as far as they go, joined by blanks."""
    return "concat_ws(' ', word, " + ", ".join(f"lead(word, {i}) OVER o" for i in range(1, length)) + ")"


def _escaped(c: str) -> str:
    return rf"regexp_replace({c}, '<(\\*)\|', '<\1\\|', 'g')"


ORACLES: dict[str, str] = {
    "op1_chat_formatting": f"""
      WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
      )
      SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
          AS loss_sha256,
        CAST(sum(24 + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
      FROM said GROUP BY conv_id""",
    "op4_exact_top_k": """
      WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      ),
      pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
      )
      SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
      WHERE rank <= 20""",
    "op7_minhash_near_dedup": f"""
      WITH RECURSIVE texts AS (SELECT doc_id, {_words(_LOWER)} AS w FROM documents),
      words AS (SELECT doc_id, len(w) AS size, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM texts),
      runs AS (
        SELECT doc_id, size, pos, {_run(4)} AS shingle FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
      ),
      held AS MATERIALIZED (
        SELECT *, count(*) OVER (PARTITION BY doc_id) AS n
        FROM (SELECT DISTINCT doc_id, shingle FROM runs WHERE pos <= greatest(1, size - 3))
      ),
      near AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM held a JOIN held b ON a.shingle = b.shingle
          AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
      ),
      links AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
      reach AS (
        SELECT doc_id AS a, doc_id AS b FROM texts
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
      ),
      roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
      sizes AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id)
      SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
      FROM roots LEFT JOIN sizes USING (doc_id)""",
    "op9_substring_dedup": f"""
      WITH texts AS (SELECT doc_id, {_words('text')} AS w FROM documents),
      words AS MATERIALIZED (
        SELECT doc_id, len(w) AS size, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM texts
      ),
      runs AS MATERIALIZED (
        SELECT doc_id, pos, size, word, md5({_run(35)}) AS h FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
      ),
      twice AS (SELECT h FROM runs WHERE pos <= size - 34 GROUP BY h HAVING count(*) > 1),
      judged AS (
        SELECT doc_id, pos, word, max(CASE WHEN t.h IS NOT NULL AND pos <= size - 34 THEN 1 ELSE 0 END) OVER (
          PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone
        FROM runs r LEFT JOIN twice t ON r.h = t.h
      ),
      done AS (
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
          string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
        FROM judged GROUP BY doc_id
      )
      SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
      FROM texts t LEFT JOIN done d ON t.doc_id = d.doc_id""",
}
