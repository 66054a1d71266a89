"""SQL of the operators that SQL can express, over the same whole tables."""

from __future__ import annotations

from pulselake.llm.licenses import _RUNNING, PUNCTUATION, SPELLINGS, all_texts

_WORD = r"[^\x20\x09-\x0D]+"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spelled(column: str) -> str:
    for variant, chosen in SPELLINGS.items():
        column = rf"regexp_replace({column}, '\b{variant}\b', '{chosen}', 'g')"
    return column


def _lines(column: str) -> str:
    plain = f"regexp_replace(lower(replace({column}, '©', '(c) ')), '{PUNCTUATION}', ' ', 'g')"
    # Without a look ahead: a statement goes on, and not with one of the words of running text.
    owner = "^ ?(c ?)?(copyright|copr) "
    statement = (
        rf"(regexp_matches(l, '{owner}[^\s]') AND NOT regexp_matches(l, '{owner}{_RUNNING}')) "
        r"OR regexp_matches(l, '^ ?(c ?)?c [0-9]{4}\b') OR regexp_matches(l, '^ ?all rights reserved ?$')"
    )
    return f"array_to_string(list_transform(string_split({plain}, chr(10)), lambda l: CASE WHEN {statement} THEN '' ELSE l END), chr(10))"


def _flat(column: str) -> str:
    return _spelled(rf"trim(regexp_replace({column}, '[ \n]+', ' ', 'g'), ' ')")


_MIXING = rf"""
WITH rated AS (
  SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), sized AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '{_WORD}')), 0) AS size,
         -ln((('0x' || substr(md5('7:' || d.doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / coalesce(CASE WHEN r.quality > 0 THEN 2.0 WHEN r.quality IS NOT NULL THEN 0.5 END, 1.0) AS key
  FROM documents d LEFT JOIN rated r ON d.doc_id = r.doc_id
), sources AS (
  SELECT source, sum(size) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS full_at,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
           / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), aims AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(level, full_at) FROM levels WHERE level <= full_at)) AS target
  FROM levels
), placed AS (
  SELECT s.*, a.source_size, a.target,
         CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
), counted AS (
  SELECT *, (epochs + CASE WHEN size > 0 AND ahead + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END)::INTEGER AS copies FROM placed
)
SELECT doc_id, size::BIGINT AS size, source, source_size::BIGINT AS source_size, target, copies, (copies * size)::BIGINT AS taken FROM counted
"""

_KNOWN = ", ".join(f"({_literal(name)}, {_literal(text)})" for name, text in all_texts())
_LICENSES = rf"""
WITH known AS (
  SELECT md5({_flat(_lines("t"))}) AS digest, min(name) AS license FROM (VALUES {_KNOWN}) v(name, t) GROUP BY 1
), units AS (
  SELECT doc_id, {_lines("text")} AS body FROM documents WHERE text <> ''
), parts AS (
  SELECT doc_id, -1 AS line, body AS unit FROM units
  UNION ALL
  SELECT doc_id, i - 1 AS line, string_split(body, chr(10))[i] AS unit
  FROM units, range(1, len(string_split(body, chr(10))) + 1) r(i) WHERE len(string_split(body, chr(10))) > 1
), found AS (
  SELECT p.doc_id, p.line, k.license FROM (SELECT doc_id, line, {_flat("unit")} AS unit FROM parts) p
  JOIN known k ON k.digest = md5(p.unit) WHERE p.unit <> ''
), grouped AS (
  SELECT doc_id, max(license) FILTER (line < 0) AS whole_license, count(*) FILTER (line >= 0) AS n_license_lines,
         array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE length(d.text) - length(replace(d.text, chr(10), '')) + 1 END::BIGINT AS n_lines,
       g.whole_license, coalesce(g.n_license_lines, 0)::BIGINT AS n_license_lines, coalesce(g.licenses, '') AS licenses
FROM documents d LEFT JOIN grouped g ON d.doc_id = g.doc_id
"""

_SUBSTRINGS = rf"""
WITH split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM split)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT i + j) AS places FROM later, range(20) r(j) GROUP BY doc_id
)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, p: NOT coalesce(list_contains(places, p), false)), ' ')) AS kept_sha256
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
"""

_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least l ON e.vec_id = l.a
"""

def _crc32(text: str) -> str:
    """CRC-32 of an ASCII column, four bits at a time."""
    table = []
    for entry in range(16):
        for _ in range(4):
            entry = entry >> 1 ^ (0xEDB88320 if entry & 1 else 0)
        table.append(f"{entry}::UBIGINT")
    step = lambda x: f"xor({x} >> 4, [{', '.join(table)}][({x} & 15)::BIGINT + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {step(step('xor(c, b)'))}), 4294967295::UBIGINT)"


def _edit(state: str, cost: str, mark: str, line: str | None = None) -> str:
    text = f"{state}.t" if line is None else f"list_append({state}.t, {line})"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'e': {state}.e || '{mark}', 't': {text}}} END"


def _keep(state: str, initial: str) -> str:
    return f"CASE WHEN NOT r.gone AND r.initial = '{initial}' THEN {_edit(state, 'r.late', 'K', 'r.line')} END"


def _change(state: str, role: str) -> str:
    return f"CASE WHEN NOT r.gone THEN {_edit(state, '2 + r.late', 'R', f"'{role}:' || r.text")} END"


def _closed(rows: str) -> str:
    """Each state with the turns inserted that lead to it cheapest."""
    users = ", ".join(_edit(s, "2", "I", "'user:'") for s in "nsa")
    return f"""
  SELECT conv_id, i, n, s, u, least(a, {_edit("u", "2", "I", "'assistant:'")}) AS a FROM (
    SELECT conv_id, i, n, s, least(u, {users}) AS u, a FROM ({rows}))"""


def _repair() -> str:
    """Least edits by the four states of the role order: nothing yet, after ``s``, after ``u``, after ``a``."""
    to_user = ", ".join(way for s in ("p.n", "p.s", "p.a") for way in (_keep(s, "u"), _change(s, "user")))
    gone = {s: _edit(f"p.{s}", "3", "D") for s in "nsua"}
    nothing = "NULL::STRUCT(c BIGINT, e VARCHAR, t VARCHAR[])"
    start = "{'c': 0::BIGINT, 'e': '', 't': []::VARCHAR[]}"
    begin = _closed(f"SELECT conv_id, 0::BIGINT AS i, {start} AS n, {nothing} AS s, {nothing} AS u, {nothing} AS a FROM conversations GROUP BY conv_id")
    go_on = _closed(f"""
    SELECT p.conv_id, r.i, {gone["n"]} AS n, least({gone["s"]}, {_keep("p.n", "s")}) AS s, least({gone["u"]}, {to_user}) AS u,
           least({gone["a"]}, {_keep("p.u", "a")}, {_change("p.u", "assistant")}) AS a
    FROM parse p JOIN judged r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1""")
    code = _crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    return rf"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {code} % 20 AS code FROM conversations
), spoilt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE code WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded
), told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         CASE WHEN role = '' THEN ' ' ELSE substr(role, 1, 1) END AS initial,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM spoilt
), judged AS (
  SELECT conv_id, i, turn, initial, text, role || ':' || text AS line, body = '' AS blank, body <> '' AND nth > 1 AS repeated,
         body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated,
         body = '' OR nth > 1 AS gone, CASE WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS late,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS step
  FROM told
), parse AS ({begin}
  UNION ALL {go_on}
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (repeated) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), best AS (
  SELECT p.conv_id, least(p.n, p.a) AS found, c.* EXCLUDE (conv_id, n)
  FROM parse p LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id WHERE p.i = coalesce(c.n, 0)
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, found.c::BIGINT AS cost, found.e AS audit,
       sha256(array_to_string(found.t, chr(10))) AS repaired_sha256
FROM best
"""


ORACLES: dict[str, str] = {
    "op2_substring_dedup": _SUBSTRINGS,
    "op4_vector_dedup": _VECTORS,
    "op5_source_mixing": _MIXING,
    "op10_license_scan": _LICENSES,
    "op11_turn_repair": _repair(),
}
