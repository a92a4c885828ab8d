"""SQL over the raw page records, for the checks: the current record of each leaf and its loosely shaped parts, exploded."""

from __future__ import annotations


def each(src: str, parent: str, field: str, name: str, keep: str) -> str:
    """CTEs that end in ``name``: the objects of a repeated field with their numbers (``name``_n, ``name``_e)."""
    objects = "json_type(v) = 'OBJECT' AND len(json_keys(v)) > 0"
    numbered = "len(list_filter(json_keys(v), lambda k: NOT regexp_full_match(trim(k), '[0-9]+'))) = 0"
    return f"""{name}0 AS (SELECT {keep}, json_extract({parent}, '$.{field}') AS v FROM {src}),
    {name}1 AS (SELECT {keep}, CASE WHEN json_type(v) = 'VARCHAR' THEN TRY_CAST(json_extract_string(v, '$') AS JSON) ELSE v END AS v FROM {name}0),
    {name}2 AS (SELECT {keep}, unnest(CASE WHEN json_type(v) = 'ARRAY' THEN list_transform(range(json_array_length(v)::BIGINT), lambda i: {{'n': (i + 1)::VARCHAR, 'e': json_extract(v, '$[' || i || ']')}})
        WHEN {objects} AND {numbered} THEN list_transform(json_keys(v), lambda k: {{'n': trim(k)::BIGINT::VARCHAR, 'e': json_extract(v, '$."' || k || '"')}})
        WHEN {objects} THEN [{{'n': '1', 'e': v}}] ELSE [] END) AS x FROM {name}1),
    {name} AS (SELECT {keep}, x.n AS {name}_n, x.e AS {name}_e FROM {name}2 WHERE json_type(x.e) = 'OBJECT')"""


def scalar(parent: str, field: str) -> str:
    return f"CASE WHEN json_type({parent}, '$.{field}') IN ('ARRAY', 'OBJECT', 'NULL') THEN NULL ELSE json_extract_string({parent}, '$.{field}') END"


def whole(text: str) -> str:
    """A number as it is written in ids; other text as it is."""
    return f"CASE WHEN TRY_CAST(trim({text}) AS DOUBLE) IS NOT NULL AND TRY_CAST(trim({text}) AS DOUBLE) = floor(TRY_CAST(trim({text}) AS DOUBLE)) THEN TRY_CAST(trim({text}) AS DOUBLE)::BIGINT::VARCHAR ELSE nullif(trim({text}), '') END"


def listed(parent: str, field: str) -> str:
    """A list field as a list of JSON, its loose shapes read."""
    v = f"CASE WHEN json_type({parent}, '$.{field}') = 'VARCHAR' THEN TRY_CAST(json_extract_string({parent}, '$.{field}') AS JSON) ELSE json_extract({parent}, '$.{field}') END"
    return f"""CASE WHEN json_type({v}) = 'ARRAY' THEN list_transform(range(json_array_length({v})::BIGINT), lambda i: json_extract({v}, '$[' || i || ']'))
        WHEN json_type({v}) = 'OBJECT' THEN list_transform(list_sort(list_transform(json_keys({v}), lambda k: TRY_CAST(trim(k) AS BIGINT))), lambda k: json_extract({v}, '$."' || k || '"')) END"""


def number(text: str, kind: str = "INT") -> str:
    return f"trunc(TRY_CAST({text} AS DOUBLE))::{kind}" if kind == "INT" else f"TRY_CAST({text} AS {kind})"


CURRENT = """cur AS (SELECT leaf, body::JSON AS b FROM (SELECT leaf, body, row_number() OVER (PARTITION BY leaf ORDER BY written_at DESC NULLS LAST, body DESC) AS k
    FROM page_json WHERE leaf IS NOT NULL AND json_valid(body) AND json_type(body) = 'OBJECT') WHERE k = 1)"""
_COL = f"coalesce({whole(scalar('c_e', 'n'))}, c_n)"
COLUMNS = f"{CURRENT}, {each('cur', 'b', 'columns', 'c', 'leaf, b')}, col AS (SELECT leaf, b, {_COL} AS n, c_e FROM c)"
PARAGRAPHS = f"{COLUMNS}, {each('col', 'c_e', 'paragraphs', 'p', 'leaf, b, n, c_e')}"
LINES = f"{PARAGRAPHS}, {each('p', 'p_e', 'lines', 'l', 'leaf, b, n, c_e, p_n, p_e')}"
_BOX = ", ".join(f"{number(f'box[{k}]->>{chr(39)}${chr(39)}')} AS {name}" for k, name in enumerate(("x0", "y0", "x1", "y1"), 1))
PAGE_LINES = f"""{LINES}, pb AS (SELECT leaf, {listed('b', 'size')} AS size, n, p_n, {scalar('p_e', 'hanging')} AS hanging, l_n, {listed('l_e', 'bbox')} AS box, {scalar('l_e', 'base')} AS base, {scalar('l_e', 'ind')} AS ind,
    {scalar('l_e', 'fs')} AS fs, {scalar('l_e', 'text')} AS text, {listed('l_e', 'words')} AS words FROM l),
    pl AS (SELECT leaf, {number("size[1]->>'$'")} AS width, {number('n')} AS n, p_n::INT AS para, TRY_CAST(hanging AS BOOLEAN) AS hanging, l_n::INT AS line, {_BOX}, {number('base')} AS base, {number('ind')} AS ind, TRY_CAST(fs AS DOUBLE) AS fs,
    text, list_transform(words, lambda w: CASE WHEN json_type(w) = 'ARRAY' THEN list_transform(range(json_array_length(w)::BIGINT), lambda i: json_extract_string(w, '$[' || i || ']')) END) AS words FROM pb),
    ln AS (SELECT * FROM pl WHERE x0 IS NOT NULL)"""
_WBOX = ", ".join(f"TRY_CAST(w[{k}] AS DOUBLE) AS {name}" for k, name in enumerate(("x0", "y0", "x1", "y1"), 2))
WORDS = f"{PAGE_LINES}, wx AS (SELECT leaf, width, n, unnest(words) AS w FROM ln), wd AS (SELECT * FROM (SELECT leaf, width, n, w[1] AS text, {_WBOX}, {number('w[6]')} AS conf FROM wx) WHERE x0 IS NOT NULL)"

CHILDREN = f"""{LINES}, {each('cur', 'b', 'entries_hint', 'h', 'leaf')}, {each('cur', 'b', 'headings', 'g', 'leaf')}, pk AS (SELECT DISTINCT leaf, n || '/' || p_n AS k FROM p),
    hk AS (SELECT leaf, h_n, coalesce({whole(scalar('h_e', 'col'))}, 'None') || '/' || coalesce({whole(scalar('h_e', 'para'))}, 'None') AS k FROM h), gk AS (SELECT leaf, g_n, {whole(scalar('g_e', 'before_col'))} AS k FROM g),
    ch AS (SELECT DISTINCT leaf AS idx, 'column' AS kind, n AS child, 'page' AS parent FROM col UNION SELECT leaf, 'paragraph', n || '/' || p_n, n FROM p UNION SELECT leaf, 'line', n || '/' || p_n || '/' || l_n, n || '/' || p_n FROM l
    UNION SELECT hk.leaf, 'hint', h_n, coalesce(pk.k, '') FROM hk LEFT JOIN pk ON pk.leaf = hk.leaf AND pk.k = hk.k
    UNION SELECT gk.leaf, 'heading', g_n, coalesce(q.n, '') FROM gk LEFT JOIN (SELECT DISTINCT leaf, n FROM col) q ON q.leaf = gk.leaf AND q.n = gk.k)"""
