"""The same results in SQL for DuckDB, where it can express them; written apart from the Spark code.

Tokenizers (1, 4, 8), XXH64 (7), learned rules (6), the license rules (9) and approximate search (10)
are not expressible.
"""

from __future__ import annotations

from wordloom.llm import secrets

SUBSTRINGS = r"""
    WITH cut AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM cut),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM cut WHERE len(w) >= 35)),
    repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
    gone AS (
        SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN repeated USING (s), range(35) r(k)),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
        FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM cut LEFT JOIN kept USING (doc_id)"""

_SYMBOL = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({v} >> {s}) & 31), 1)"
_FIVE = "('0x' || substr(h, {at}, 5))::BIGINT"
# Five hex digits are four symbols of base 32.
_BASE32 = " || ".join(
    _SYMBOL.format(v=_FIVE.format(at=1 + 5 * i), s=s) for i in range(8) for s in (15, 10, 5, 0)
)
WARC = f"""
    WITH hashed AS (
        SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
    told AS (SELECT page_id, n, {_BASE32} AS digest FROM hashed),
    first AS (SELECT *, min(page_id) OVER (PARTITION BY digest, n) AS response FROM told)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
    FROM first"""


def _found(number: int, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
        SELECT doc_id, {number} AS kind, stop - size AS start, stop
        FROM (SELECT doc_id, size, measured, sum(gap + size) OVER (PARTITION BY doc_id ORDER BY k) AS stop
              FROM (SELECT doc_id, k, len(g[k]) AS gap, len(m[k]) AS size, len(x[k]) AS measured
                    FROM (SELECT doc_id, m, g, x, unnest(range(1, len(m) + 1)) AS k
                          FROM (SELECT doc_id, regexp_extract_all(text, {p}) AS m, string_split_regex(text, {p}) AS g,
                                       regexp_extract_all(text, {p}, {group}) AS x
                                FROM documents WHERE regexp_matches(text, {p})))))
        WHERE measured >= {least}"""


_NAMES = "[" + ", ".join(f"'{kind}'" for kind, *_ in secrets.KINDS) + "]"
_ROLES = "[" + ", ".join(f"'{secrets.ROLES[kind]}'" for kind, *_ in secrets.KINDS) + "]"
_SHOWN = f"{_NAMES}[kind + 1] || ':' || start || ':' || stop"
SECRETS = f"""
    WITH found AS MATERIALIZED ({" UNION ALL ".join(_found(i, p, g, n) for i, (_, p, g, n) in enumerate(secrets.KINDS))}),
    roles AS (SELECT *, {_ROLES}[kind + 1] AS role FROM found),
    met AS (
        SELECT w.doc_id, w.kind, w.start, w.stop, any_value(w.role) AS own,
               bool_or(o.role = 'name' AND (o.stop <= w.start OR o.start >= w.stop)) AS named,
               bool_or(o.role = 'secret' AND (o.stop <= w.start OR o.start >= w.stop)) AS secret,
               bool_or(o.kind <= 2 AND NOT (o.stop <= w.start OR o.start >= w.stop)) AS known
        FROM roles w JOIN roles o ON o.doc_id = w.doc_id AND o.role <> 'place'
             AND o.start <= w.stop + {secrets.SCOPE} AND o.stop >= w.start - {secrets.SCOPE}
        WHERE w.kind > 2 GROUP BY ALL),
    every AS (
        SELECT doc_id, kind, start, stop FROM found WHERE kind <= 2
        UNION ALL
        SELECT doc_id, kind, start, stop FROM met
        WHERE NOT known AND CASE own WHEN 'name' THEN secret WHEN 'secret' THEN named ELSE named AND secret END)
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
           count(*) FILTER (WHERE kind = 2) AS n_hex,
           sha256(coalesce(string_agg({_SHOWN}, ',' ORDER BY start, kind) FILTER (WHERE kind <= 2), '')) AS base_sha256,
           coalesce(string_agg({_SHOWN}, ',' ORDER BY start, kind) FILTER (WHERE kind IS NOT NULL), '') AS spans
    FROM documents LEFT JOIN every USING (doc_id) GROUP BY doc_id"""

_FAILS = [
    "n < 100",
    "100 * distinct_words < 80 * n",
    "100 * capitals > 10 * points",
    "symbol",
    "doc_id > first_id",
]
FILTER_AUDIT = f"""
    WITH cut AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    told AS (
        SELECT doc_id, part, len(w) AS n, len(list_distinct(w)) AS distinct_words, len(t) AS points,
               len(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, regexp_matches(t, '[#$%&*|]') AS symbol,
               min(doc_id) OVER (PARTITION BY t) AS first_id FROM cut),
    known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    judged AS (
        SELECT part, [{", ".join(_FAILS)}] AS f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
        FROM told LEFT JOIN known USING (doc_id)),
    cells AS (
        SELECT part, f, count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
        FROM judged GROUP BY part, f),
    letters AS (SELECT unnest(range(1, 6)) AS l),
    orders AS (
        SELECT [a.l, b.l, c.l, d.l, e.l] AS o FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
    steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
    met AS (
        SELECT part, o, step, docs, good, toxic, f[o[step]] AS fails,
               len(list_filter(o[: step - 1], lambda i: f[i])) > 0 AS gone,
               len(list_filter(f, lambda x: x)) AS failures
        FROM cells, steps),
    counted AS (
        SELECT part, o, step, coalesce(sum(docs) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept,
               coalesce(sum(docs) FILTER (WHERE NOT gone AND fails), 0) AS removed,
               coalesce(sum(docs) FILTER (WHERE gone AND fails), 0) AS redundant,
               coalesce(sum(docs) FILTER (WHERE fails AND failures = 1), 0) AS unique_fails,
               coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
        FROM met GROUP BY part, o, step)
    SELECT part, array_to_string(list_transform(o, lambda i: chr(64 + i::INT)), '') AS filter_order, step::INT AS step,
           kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley
    FROM counted"""

SUFFIX_DEDUP = """
    WITH cut AS (SELECT doc_id, encode(coalesce(text, '')) AS d, strlen(coalesce(text, '')) AS n FROM documents),
    -- A thousand places are cut from a document at a time, so no step copies the whole of it for a byte.
    blocks AS (SELECT doc_id, n, k, d[k + 1 : k + 1123] AS d FROM (SELECT doc_id, d, n, unnest(range(0, n, 1024)) AS k FROM cut)),
    places AS (
        SELECT doc_id, k + i AS p, hex(d[i + 1 : i + 1]) AS byte,
               CASE WHEN k + i + 100 <= n THEN md5_number(hex(d[i + 1 : i + 100])) END AS s
        FROM (SELECT *, unnest(range(least(1024, n - k))) AS i FROM blocks)),
    later AS (
        SELECT doc_id, p, byte,
               CASE WHEN s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 THEN p END AS q
        FROM places),
    told AS (SELECT doc_id, p, byte, coalesce(max(q) OVER (PARTITION BY doc_id ORDER BY p) > p - 100, false) AS gone FROM later),
    edged AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS edge FROM told),
    kept AS (
        SELECT doc_id, count(*) FILTER (WHERE gone) AS removed, count(*) FILTER (WHERE edge) AS spans,
               string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS left_hex
        FROM edged GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
           sha256(unhex(coalesce(left_hex, ''))) AS kept_sha256
    FROM cut LEFT JOIN kept USING (doc_id)"""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_TERMS = r"regexp_extract_all(translate(text, {u}, lower({u})), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(u=_UPPER)
RANKED_SEARCH = f"""
    WITH cut AS (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
    sized AS (SELECT doc_id, w, len(w) AS n FROM cut WHERE len(w) > 0),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sized),
    placed AS (SELECT doc_id, n, unnest(w) AS term FROM sized),
    counted AS (SELECT doc_id, n, term, count(*) AS tf FROM placed GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
        FROM counted, whole GROUP BY term),
    asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
    scored AS (
        SELECT item_id, doc_id,
               sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
        FROM asked JOIN counted USING (term) JOIN weights USING (term), whole GROUP BY ALL)
    SELECT item_id, (row_number() OVER best)::INT AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
    QUALIFY row_number() OVER best <= 50"""

ORACLES = {
    "op2_substrings": SUBSTRINGS,
    "op3_warc": WARC,
    "op5_secrets": SECRETS,
    "op11_suffix_dedup": SUFFIX_DEDUP,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_filter_audit": FILTER_AUDIT,
}
