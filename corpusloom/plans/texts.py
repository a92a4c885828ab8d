"""Scalar text functions over the book's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import entries as E
from corpusloom.session import table


def _heads(spark, d):
    return table(spark, d, "entries").select("id", "headword", "headword_civil", "headword_key").where("headword is not null").distinct()


def _definitions(spark, d):
    return table(spark, d, "entries").select("id", "definition").where("definition is not null").distinct()


def civil_heads(spark, d):
    """The civil spelling of the book's heads, and whether the table's own agrees."""
    c = X.civil(F.col("headword"))
    return _heads(spark, d).select("id", c.alias("civil"), (c == F.col("headword_civil")).alias("same"))


def modern_heads(spark, d):
    return _heads(spark, d).select("id", X.modern_key(X.civil(F.col("headword"))).alias("key"), X.soft_key(X.modern_key(X.civil(F.col("headword")))).alias("soft"))


def tidy_definitions(spark, d):
    """Spacing repaired: plain tidy, and with all white space as single spaces."""
    return _definitions(spark, d).select("id", X.tidy(F.col("definition")).alias("tidy"), X.clean_spacing(F.col("definition")).alias("clean"))


def joined_lines(spark, d):
    """Printed lines of text_d joined; words cut by a hyphen become whole."""
    p = table(spark, d, "paragraphs").select("para_id", "text_d").where("text_d is not null").distinct()
    return p.select("para_id", X.join_lines(F.split("text_d", "\n")).alias("text"))


def paren_balance(spark, d):
    x = X.paren_depths(F.col("definition"))
    return _definitions(spark, d).select("id", x["open"].alias("open"), x["bad"].alias("bad"))


def separator_split(spark, d):
    """Paragraphs cut at the first separator: head, separator's place, the rest."""
    p = table(spark, d, "paragraphs").select("para_id", "text_merged").where("text_merged is not null").distinct()
    at = X.separator_at(F.col("text_merged"))
    return p.select(
        "para_id",
        at.alias("at"),
        F.when(at > 0, F.trim(F.substring("text_merged", F.lit(1), at - 1))).alias("head"),
        F.when(at > 0, F.trim(F.substring(F.col("text_merged"), at + 1, F.length("text_merged")))).alias("rest"),
    )


def script_counts(spark, d):
    """Letters of each script in heads, words that mix scripts, mostly capital heads, Roman numerals."""
    h = F.col("headword")
    return _heads(spark, d).select(
        "id",
        X.script_letters(h, "Cyrillic").alias("cyrillic"),
        X.script_letters(h, "Latin").alias("latin"),
        X.script_letters(h, "Greek").alias("greek"),
        X.mixed_script(h).alias("mixed"),
        F.coalesce(F.regexp_count(h, F.lit(r"\p{Lu}")), F.lit(0)).alias("capitals"),
        X.is_roman(h).alias("roman"),
    )


def guide_words(spark, d):
    """The guide words of each leaf: the first and the last head in the order of their places."""
    e = _heads(spark, d).where("headword != ''").withColumn("leaf", F.split("id", "-")[0].cast("int"))
    g = X.guide_word(F.col("headword"))
    return e.groupBy("leaf").agg(F.min_by(g, F.struct("id", "headword")).alias("first"), F.max_by(g, F.struct("id", "headword")).alias("last"))


def packed_spans(spark, d):
    """Spans of the italic column unpacked, with the text they cover."""
    e = table(spark, d, "entries").select("id", "definition", "italic").where("definition is not null").distinct()
    each = e.select("id", "definition", F.explode(X.unpack_spans(F.col("italic"))).alias("x"))
    return each.select("id", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.substring("definition", F.col("x.s") + 1, F.col("x.e") - F.col("x.s")).alias("piece"))


def spans_packed_again(spark, d):
    """Unpacked and packed again: the same text where it was well formed."""
    e = table(spark, d, "entries").select("id", "disputed").distinct()
    return e.select("id", X.pack_spans(X.unpack_spans(F.col("disputed"))).alias("packed"))


def event_props(spark, d):
    """The JSON of events' properties, and an answer list made of it read back."""
    e = table(spark, d, "events").select("event_id", "props", "event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    answer = X.json_answer(F.concat(F.lit('answer: ["'), F.col("event_type"), F.lit('", "x"] .')))
    return e.select("event_id", k.alias("k"), answer[0].alias("first"), F.size(answer).alias("n"))


def head_distances(spark, d):
    """Edits between the look-up key and the key of the head as read, within four (-1 beyond), in letters."""
    key = X.modern_key(X.civil(F.col("headword")))
    e = _heads(spark, d).where("headword_key is not null")
    return e.select("id", F.levenshtein("headword_key", key, 4).alias("edits"))


def normal_forms(spark, d):
    """The normal form of the heads, with back pointers (no SQL has them)."""
    n = X.norm_sequence(F.col("headword"))
    return _heads(spark, d).select("id", X.squash(F.col("headword")).alias("norm"), n["seq"].alias("seq"), n["at"].alias("at"))


def unescaped_texts(spark, d):
    """Documents without HTML escapes, digits as ASCII, and folded."""
    t = table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    return t.select("doc_id", X.unescape(X.ascii_digits(F.col("text"))).alias("plain"), X.without_marks(F.col("text")).alias("folded"))


def split_entries(spark, d):
    """Paragraphs, of which nothing else is known, split into head, separator, grammar and definition, with flags."""
    p = table(spark, d, "paragraphs").select("para_id", "text_merged").where("text_merged is not null").distinct()
    return E.split_entries(p, ["para_id"], "text_merged")


def assembled_entries(spark, d):
    """Paragraphs of the book assembled to entries across columns and leaves; ``leaf`` is that of the first paragraph."""
    p = table(spark, d, "paragraphs").groupBy("leaf", "col", "para").agg(F.max("hanging").alias("hanging"), F.max("text_d").alias("text_d"))
    return E.assembled(p, [], ["leaf", "col", "para"], "hanging", "text_d", "leaf").withColumnRenamed("first_leaf", "leaf")


QUERIES = {
    f.__name__: f
    for f in (civil_heads, modern_heads, tidy_definitions, joined_lines, paren_balance, separator_split, script_counts, guide_words, packed_spans, spans_packed_again,
              event_props, head_distances, normal_forms, unescaped_texts, split_entries, assembled_entries)
}

_CIVIL = X.civil_sql("headword")
_KEY = rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(replace(replace(lower({_CIVIL}), 'аѵ', 'ав'), 'еѵ', 'ев'), 'ѣіѳѵ', 'еифи'), 'ъ([\s\-,;])', '\1', 'g'), 'ъ$', ''), '[^\p{{L}}\p{{N}}_\s\-]', '', 'g'), '\s+', ' ', 'g'), ' ')"
_H = "h AS (SELECT DISTINCT id, headword, headword_civil, headword_key FROM entries WHERE headword IS NOT NULL)"
_D = "d AS (SELECT DISTINCT id, definition FROM entries WHERE definition IS NOT NULL)"
_SPANS = "list_transform(list_filter(string_split(coalesce({c}, ''), ';'), lambda x: regexp_full_match(x, '[0-9]+-[0-9]+')), lambda x: {{'s': split_part(x, '-', 1)::INT, 'e': split_part(x, '-', 2)::INT}})"

ORACLE = {
    "civil_heads": f"WITH {_H} SELECT id, {_CIVIL} AS civil, {_CIVIL} = headword_civil AS same FROM h",
    "modern_heads": f"WITH {_H} SELECT id, {_KEY} AS key, translate({_KEY}, 'йьъ', 'и') AS soft FROM h",
    "tidy_definitions": rf"""WITH {_D} SELECT id, regexp_replace(regexp_replace(regexp_replace(definition, ' $', ''), ' ([.,;:)])', '\1', 'g'), '([( ]) +', '\1', 'g') AS tidy,
        trim(regexp_replace(regexp_replace(regexp_replace(definition, '\s+([.,;:!?)])', '\1', 'g'), '\(\s+', '(', 'g'), '\s+', ' ', 'g'), ' ') AS clean FROM d""",
    "joined_lines": r"""SELECT para_id, replace(regexp_replace(text_d, '([^ \n])[-¬‐]\n', '\1', 'g'), chr(10), ' ') AS text FROM (SELECT DISTINCT para_id, text_d FROM paragraphs WHERE text_d IS NOT NULL)""",
    "separator_split": rf"""WITH p AS (SELECT DISTINCT para_id, text_merged AS t FROM paragraphs WHERE text_merged IS NOT NULL),
        m AS (SELECT *, [length(regexp_extract(t, '^(?s)(.*?)(?:=|—|–|--|\s-\s|\()', 1)), length(regexp_extract(t, '^(?s)(.*?\S)-\s*{X.ABBREVIATION}\.', 1)), length(regexp_extract(t, '^(?s)(.*?\.)\s?-\s?\S', 1))] AS x,
        [regexp_matches(t, '=|—|–|--|\s-\s|\('), regexp_matches(t, '\S-\s*{X.ABBREVIATION}\.'), regexp_matches(t, '\.\s?-\s?\S')] AS h FROM p),
        a AS (SELECT para_id, t, coalesce(list_min(list_transform(list_filter([1, 2, 3], lambda k: h[k]), lambda k: x[k] + 1)), 0)::INT AS x FROM m)
        SELECT para_id, x AS "at", CASE WHEN x > 0 THEN trim(left(t, x - 1), ' ') END AS head, CASE WHEN x > 0 THEN trim(substr(t, x + 1), ' ') END AS rest FROM a""",
    "script_counts": r"""WITH h AS (SELECT DISTINCT id, headword FROM (SELECT DISTINCT id, headword, headword_civil, headword_key FROM entries WHERE headword IS NOT NULL))
        SELECT id, len(regexp_extract_all(headword, '\p{Cyrillic}'))::INT AS cyrillic, len(regexp_extract_all(headword, '\p{Latin}'))::INT AS latin, len(regexp_extract_all(headword, '\p{Greek}'))::INT AS greek,
        regexp_matches(headword, '\p{Latin}\p{Greek}|\p{Latin}\p{Cyrillic}|\p{Greek}\p{Latin}|\p{Greek}\p{Cyrillic}|\p{Cyrillic}\p{Latin}|\p{Cyrillic}\p{Greek}') AS mixed,
        len(regexp_extract_all(headword, '\p{Lu}'))::INT AS capitals, regexp_full_match(replace(replace(translate(headword, 'ХІѴСМД', 'XIVCMD'), 'П', 'II'), 'Ш', 'III'), '[IVXLCDM]+') AS roman FROM h""",
    "guide_words": rf"""WITH {_H}, e AS (SELECT split_part(id, '-', 1)::INT AS leaf, id, headword, left(regexp_replace(headword, '[^\p{{L}}]', '', 'g'), 3) || '—' AS g FROM h WHERE headword <> '')
        SELECT leaf, min_by(g, (id, headword)) AS first, max_by(g, (id, headword)) AS last FROM e GROUP BY leaf""",
    "packed_spans": f"""WITH e AS (SELECT id, definition, unnest({_SPANS.format(c='italic')}) AS x FROM (SELECT DISTINCT id, definition, italic FROM entries WHERE definition IS NOT NULL))
        SELECT id, x.s AS s, x.e AS e, substr(definition, x.s + 1, x.e - x.s) AS piece FROM e""",
    "spans_packed_again": f"""SELECT id, array_to_string(list_transform({_SPANS.format(c='disputed')}, lambda x: x.s || '-' || x.e), ';') AS packed FROM (SELECT DISTINCT id, disputed FROM entries)""",
    "event_props": "SELECT event_id, (props->>'$.k')::INT AS k, event_type AS first, 2 AS n FROM events",
}

ORACLE |= {
    "assembled_entries": r"""WITH p AS (SELECT leaf, col, para, max(hanging) AS hanging, max(text_d) AS t FROM paragraphs GROUP BY leaf, col, para),
        g AS (SELECT *, sum(CASE WHEN coalesce(hanging, true) THEN 1 ELSE 0 END) OVER (ORDER BY leaf, col, para ROWS UNBOUNDED PRECEDING) AS g FROM p),
        a AS (SELECT g, min(leaf) AS leaf, arg_min(col, (leaf, col, para)) AS first_col, arg_min(para, (leaf, col, para)) AS first_para, count(*)::INT AS n, list(coalesce(t, '') ORDER BY leaf, col, para) AS parts FROM g GROUP BY g)
        SELECT leaf, first_col, first_para, n, list_reduce(parts, lambda x, y: CASE WHEN x = '' THEN y WHEN y = '' THEN x WHEN regexp_matches(x, '(^|[^ ])[-¬]$') THEN left(x, length(x) - 1) || y ELSE x || ' ' || y END) AS text FROM a""",
    "paren_balance": rf"""WITH {_D}, m AS (SELECT id, list_filter(list_transform(range(1, length(definition)::INT + 1), lambda i: {{'c': substr(definition, i, 1), 's': regexp_matches(left(definition, i - 1), '(^|[\s=—;:,.])([0-9]{{1,2}}|[а-я])$')}}), lambda x: x.c IN ('(', ')')) AS marks FROM d),
        r AS (SELECT id, list_reduce(list_prepend({{'open': 0, 'bad': 0}}, list_transform(marks, lambda x: {{'open': CASE WHEN x.c = '(' THEN 1 WHEN x.s THEN -2 ELSE -1 END, 'bad': 0}})),
        lambda a, x: {{'open': CASE WHEN x.open = 1 THEN a.open + 1 ELSE greatest(a.open - 1, 0) END, 'bad': a.bad + CASE WHEN x.open = -1 AND a.open = 0 THEN 1 ELSE 0 END}}) AS z FROM m)
        SELECT id, z.open AS open, z.bad AS bad FROM r""",
}
