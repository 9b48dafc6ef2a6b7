"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from vitrine.llm.chat import Template
from vitrine.llm.quality import QualityRules

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]"


def _quality() -> str:
    rules = QualityRules()
    sizes = (3, *rules.ngrams)
    # NULL where the text ends before the n-gram does
    grams = ", ".join(
        " || ' ' || ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, n)]]) + f" AS gram{n}" for n in sizes
    )
    parts = [f"""
    d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
    word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
    gram AS (SELECT doc_id, i, length(word) AS chars, {grams} FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    line AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
             WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line),
    lines AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS dup,
                CAST(sum(CASE WHEN n > 1 THEN n * length(regexp_replace(line, '{_SPACE}', '', 'g')) ELSE 0 END) AS BIGINT) AS chars
              FROM line GROUP BY doc_id)"""]
    for n in sizes:
        parts.append(f"""
    g{n} AS (SELECT doc_id, unnest(list(i)) AS i, count(*) AS n FROM gram WHERE gram{n} IS NOT NULL
             GROUP BY doc_id, gram{n} HAVING count(*) > 1),
    c{n} AS (SELECT doc_id, count(*) AS words, CAST(sum(chars) AS BIGINT) AS chars
             FROM (SELECT DISTINCT doc_id, i + unnest(range({n})) AS i FROM g{n}) JOIN gram USING (doc_id, i)
             GROUP BY doc_id)""")
    joins = " ".join(f"LEFT JOIN c{n} ON c{n}.doc_id = w.doc_id" for n in sizes)
    chars = "greatest(word_chars, 1)"
    good = " AND ".join([
        f"line_chars <= {rules.max_line_chars} * {chars}", f"n_symbols <= {rules.max_symbols} * n_words",
        *[f"ngram{n}_chars <= {rules.max_ngram_chars} * {chars}" for n in rules.ngrams],
    ])
    columns = ", ".join(f"coalesce(c{n}.chars, 0) AS ngram{n}_chars" for n in rules.ngrams)
    return f"""
    WITH {", ".join(parts)},
    m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
            length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            coalesce(lines.dup, 0) AS n_dup_lines, coalesce(c3.words, 0) AS n_repeat_words, coalesce(lines.chars, 0) AS line_chars,
            {columns}
          FROM w LEFT JOIN lines ON lines.doc_id = w.doc_id {joins}),
    f AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND {good} AS kept FROM f"""


def _chat() -> str:
    template = Template()

    def size(column: str) -> str:
        """Length after escaping: one more for every backslash and control string."""
        counts = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ("\\", *template.controls)]
        return f"length({column}) + " + " + ".join(counts)

    marks = len(template.start) + len(template.sep) + len(template.end)
    said = "</s>[INST] ok [/INST]"
    return f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{said}'), (-1, 1, '{template.target}', '{said}'))),
    p AS (SELECT *, sum({marks} + {size('role')} + {size('text')}) OVER w AS upto, row_number() OVER w AS nth,
            count(*) OVER (PARTITION BY conv_id) AS n
          FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = '{template.target}'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = '{template.target}'), '')) AS loss_sha256,
      CAST(sum(upto) FILTER (role = '{template.target}' OR nth = n) AS BIGINT) AS formatted_chars
    FROM p GROUP BY conv_id"""


_TOP_K = """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
_LEXICAL = f"""
    WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
    q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
    f AS (SELECT doc_id, any_value(n) AS n, term, count(*) AS tf
          FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
          WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
          FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
    p AS (SELECT item_id, doc_id,
            CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
          FROM q JOIN f USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
    r AS (SELECT item_id, doc_id, score,
            CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
          FROM p WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""

ORACLES: dict[str, str] = {"op6_chat": _chat(), "op8_quality": _quality(), "op10_topk": _TOP_K, "op13_lexical": _LEXICAL}
