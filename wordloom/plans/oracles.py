"""The same results in plain SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from wordloom.functions import treebank

WORD = r"'[\p{L}\p{N}_]+'"
WORDPUNCT = r"'[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]'"
PUNCT = "'!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'''"
STD_TOKENS = f"regexp_extract_all(translate(lower(text), {PUNCT}, ''), '[^ \\t\\n\\x0B\\f\\r]+')"
LOW_WORDPUNCT = f"regexp_extract_all(lower(text), {WORDPUNCT})"


def h(salt: str, key: str) -> str:
    return f"('0x' || substr(md5({salt} || ':' || ({key})::VARCHAR), 1, 15))::BIGINT"


def join(tokens: str) -> str:
    return f"coalesce(array_to_string({tokens}, ' '), '')"


TRAIN = f"{h(chr(39) + '69' + chr(39), 'doc_id')} % 100 < 80"
TEST = f"{h(chr(39) + '69' + chr(39), 'doc_id')} % 100 >= 80"


def tokens_query(tokens: str) -> str:
    return f"""
        SELECT doc_id AS id, len(t)::INTEGER AS n_tokens, {join('t')} AS tokens
        FROM (SELECT doc_id, {tokens} AS t FROM documents)"""


def rewritten(text: str) -> str:
    """The rewrite rules in their order, for RE2."""

    def apply(out: str, rules: list[tuple[str, str]]) -> str:
        for pattern, replacement in rules:
            out = f"regexp_replace({out}, '{quoted(pattern)}', '{quoted(replacement.replace('$', chr(92)))}', 'g')"
        return out

    padded = f"' ' || {apply(f'lower({text})', treebank.RULES)} || ' '"
    return apply(padded, treebank.ENDING_RULES + treebank.contraction_rules())


def quoted(text: str) -> str:
    return text.replace("'", "''")


TYPE = r"'[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*\.?'"
ABBREVIATIONS = rf"""
    WITH words AS (SELECT unnest(regexp_extract_all(lower(text), {TYPE})) AS w FROM documents),
    counts AS (
        SELECT rtrim(w, '.') AS type, count(*) FILTER (WHERE suffix(w, '.')) AS a, count(*) FILTER (WHERE NOT suffix(w, '.')) AS b
        FROM words GROUP BY 1),
    whole AS (SELECT sum(a) / sum(a + b) AS share FROM counts),
    sized AS (SELECT *, length(type) - length(replace(type, '.', '')) + 1 AS periods FROM counts, whole),
    told AS (SELECT *, length(type) - periods + 1 AS letters FROM sized WHERE a > 0 AND regexp_matches(type, '\p{{L}}'))
    SELECT type, a AS with_period, b AS without_period,
           round(CASE WHEN share < 1 THEN
               -2 * ((a * ln(share) + b * ln(1 - share)) - (a * ln(0.99::DOUBLE) + b * ln(1 - 0.99::DOUBLE)))
               * exp(-letters) * periods * pow(letters, -b) END, 6) + 0.0 AS score
    FROM told"""


def vocabulary(cap: int, where: str = "TRUE") -> str:
    return f"""
        SELECT 0 AS idx, '' AS token, NULL::BIGINT AS freq
        UNION ALL SELECT 1, '[UNK]', NULL
        UNION ALL
        SELECT (row_number() OVER (ORDER BY freq DESC, token DESC) + 1)::INTEGER, token, freq
        FROM (SELECT token, count(*) AS freq
              FROM (SELECT unnest({STD_TOKENS}) AS token FROM documents WHERE {where})
              GROUP BY token ORDER BY freq DESC, token DESC LIMIT {cap - 2})"""


def examples(tokens: str, salt: str = "'example'", source: str = "documents", key: str = "doc_id") -> str:
    """One (context, next word) example per text of more than ten tokens."""
    return f"""
        SELECT * EXCLUDE (t), {join('t[pos + 1 : pos + 10]')} AS context, t[pos + 11] AS next_word,
               t[pos + 9] AS w1, t[pos + 10] AS w2
        FROM (SELECT * EXCLUDE (t), t, ({h(salt, key)} % (len(t) - 10))::INTEGER AS pos
              FROM (SELECT * EXCLUDE (text), {tokens} AS t FROM {source}) WHERE len(t) > 10)"""


EXAMPLES_WORDS = examples(f"regexp_extract_all(text, {WORD})")


def encoded(cap: int) -> str:
    return f"""
    vocab AS ({vocabulary(cap)}),
    ex AS ({EXAMPLES_WORDS}),
    pieces AS (
        SELECT doc_id, {STD_TOKENS.replace('text', 'context')} AS c, {STD_TOKENS.replace('text', 'next_word')} AS y
        FROM ex),
    slots AS (SELECT doc_id, unnest(range(1, 11)) AS i, c, y FROM pieces),
    ids AS (
        SELECT doc_id, i - 1 AS pos,
               CASE WHEN c[i] IS NULL THEN 0 ELSE coalesce(v.idx, 1) END AS idx
        FROM slots LEFT JOIN vocab v ON v.token = c[i] AND v.idx > 1),
    targets AS (
        SELECT doc_id, CASE WHEN y[1] IS NULL THEN 0 ELSE coalesce(v.idx, 1) END::INTEGER AS label
        FROM pieces LEFT JOIN vocab v ON v.token = y[1] AND v.idx > 1)"""


ENCODED_15K = encoded(15_000)
ENCODED_20K = encoded(20_000)


def grams(where: str) -> str:
    """Count tables g1, g2, g3 of the padded texts."""
    return f"""
    padded AS (
        SELECT ['<s>', '<s>'] || {LOW_WORDPUNCT} || ['</s>', '</s>'] AS t FROM documents WHERE {where}),
    g3 AS (SELECT t[i] AS a, t[i + 1] AS b, t[i + 2] AS w, count(*) AS c
           FROM (SELECT t, unnest(range(1, len(t) - 1)) AS i FROM padded) GROUP BY ALL),
    g2 AS (SELECT t[i] AS b, t[i + 1] AS w, count(*) AS c
           FROM (SELECT t, unnest(range(1, len(t))) AS i FROM padded) GROUP BY ALL),
    g1 AS (SELECT w, count(*) AS c FROM (SELECT unnest(t) AS w FROM padded) GROUP BY ALL),
    grams AS MATERIALIZED (
        SELECT 3 AS n, a || ' ' || b AS context, w AS word, c FROM g3
        UNION ALL SELECT 2, b, w, c FROM g2
        UNION ALL SELECT 1, '', w, c FROM g1)"""


ALL_GRAMS = grams("TRUE")
TRAIN_GRAMS = grams(TRAIN)
HELD_OUT = examples(LOW_WORDPUNCT, source=f"(SELECT doc_id, text FROM documents WHERE {TEST})")

# For asked(key columns, w1, w2): the order and context found by back-off.
BACKED_OFF = """
    found AS (
        SELECT asked.*,
               CASE WHEN w1 || ' ' || w2 IN (SELECT context FROM grams WHERE n = 3) THEN 3
                    WHEN w2 IN (SELECT context FROM grams WHERE n = 2) THEN 2 ELSE 1 END AS order_used
        FROM asked),
    placed AS (
        SELECT *, CASE order_used WHEN 3 THEN w1 || ' ' || w2 WHEN 2 THEN w2 ELSE '' END AS ctx FROM found)"""

BEST = """
    best AS (SELECT n, context, word, c FROM grams
             QUALIFY row_number() OVER (PARTITION BY n, context ORDER BY c DESC, word) = 1)"""

TRIAL_ASKED = examples(
    LOW_WORDPUNCT,
    salt="'example' || trial::VARCHAR",
    source=f"""(SELECT doc_id, text, trial FROM documents, range(10) r(trial)
               WHERE {TEST} AND {h("'trial' || trial::VARCHAR", 'doc_id')} % 10 = 0)""",
)
ACCURACY = f"""
    WITH {TRAIN_GRAMS}, asked AS ({TRIAL_ASKED}), {BACKED_OFF}, {BEST},
    told AS (
        SELECT trial, count(*) FILTER (WHERE word = next_word) AS correct, count(*) AS total
        FROM placed JOIN best ON best.n = order_used AND best.context = ctx GROUP BY ALL),
    acc AS (
        SELECT r.trial::INTEGER AS trial, coalesce(correct, 0) AS correct, coalesce(total, 0) AS total,
               correct / total AS accuracy
        FROM range(10) r(trial) LEFT JOIN told USING (trial))"""


def drawn(weight: str) -> str:
    return f"""
    WITH {TRAIN_GRAMS}, asked AS ({HELD_OUT}), {BACKED_OFF},
    weighted AS (SELECT n, context, word, {weight} AS wt FROM grams),
    cum AS (SELECT n, context, word, wt,
                   sum(wt) OVER (PARTITION BY n, context ORDER BY word) AS hi,
                   sum(wt) OVER (PARTITION BY n, context) AS total
            FROM weighted)
    SELECT doc_id AS id, word
    FROM placed JOIN cum ON n = order_used AND cum.context = ctx
    WHERE {h("'draw'", 'doc_id')} % total >= hi - wt AND {h("'draw'", 'doc_id')} % total < hi"""


def context_vectors(positions: str, divisor: str) -> str:
    return f"""
    WITH {ENCODED_20K},
    counted AS (SELECT doc_id, count(*) FILTER (WHERE idx > 0) AS known FROM ids GROUP BY doc_id),
    dims AS (SELECT doc_id, unnest(range(64)) AS dim, known FROM counted),
    sums AS (
        SELECT doc_id, dim, sum(x) AS s
        FROM (SELECT doc_id, unnest(range(64)) AS dim, unnest(embedding)::DOUBLE AS x
              FROM ids JOIN embeddings ON vec_id = idx - 2 WHERE {positions})
        GROUP BY ALL)
    SELECT d.doc_id AS id, d.dim::INTEGER AS dim, round(coalesce(s, 0) / {divisor}, 6) AS value
    FROM dims d LEFT JOIN sums USING (doc_id, dim)"""


MICRO = "array_to_string(list_transform({v}, lambda x: floor(x::DOUBLE * 1000000)::BIGINT::VARCHAR), ',')"
USER_TURNS = "(SELECT conv_id * 1000 + turn AS request_id, text FROM conversations WHERE role = 'user')"
SNIPPETS = f"""
    SELECT doc_id AS id,
           CASE WHEN len(t) <= 10 THEN text
                ELSE {join("t[s + 1 : s + 10]")} END AS snippet
    FROM (SELECT doc_id, text, t, {h("'snippet'", 'doc_id')} % greatest(len(t) - 10, 1) AS s
          FROM (SELECT doc_id, text, regexp_extract_all(lower(text), {WORD}) AS t FROM documents))"""


def finished(tag: str, rounds: int) -> str:
    """The requests of every round that have their words then."""
    return " UNION ALL ".join(f"SELECT request_id, text, words FROM {tag}{i} WHERE n = {i}" for i in range(rounds + 1))


DRAW_TABLES = """
    cum AS MATERIALIZED (SELECT n, context, word, c, sum(c) OVER (PARTITION BY n, context ORDER BY word) AS hi FROM grams),
    tot AS MATERIALIZED (SELECT n, context, sum(c) AS total FROM grams GROUP BY ALL)"""


def drawn_text(tag: str, rounds: int) -> str:
    return f"""
    SELECT request_id,
           text || ' ' || coalesce(array_to_string(list_filter(words, lambda w: w NOT IN ('<s>', '</s>')), ' '), '')
           AS generated_text
    FROM ({finished(tag, rounds)})"""


def ngram_loop(rounds: int, source: str, tag: str = "r") -> str:
    """Weighted draws for the requests ``(request_id, text, n)``, one CTE per round; the tail is the last two words."""
    parts = [
        f"""{tag}0 AS MATERIALIZED (SELECT request_id, text, n, t[-2] AS w1, t[-1] AS w2, []::VARCHAR[] AS words
            FROM (SELECT request_id, text, n, {LOW_WORDPUNCT} AS t FROM {source}))"""
    ]
    for i in range(rounds):
        key = h(f"'ngram{i}'", "request_id")
        parts.append(f"""
        {tag}p{i} AS (
            SELECT r.*, coalesce(x3.total, x2.total, x1.total) AS total,
                   CASE WHEN x3.n IS NOT NULL THEN 3 WHEN x2.n IS NOT NULL THEN 2 ELSE 1 END AS k,
                   CASE WHEN x3.n IS NOT NULL THEN w1 || ' ' || w2 WHEN x2.n IS NOT NULL THEN w2 ELSE '' END AS ctx
            FROM (SELECT * FROM {tag}{i} WHERE n > {i}) r
            LEFT JOIN tot x3 ON x3.n = 3 AND x3.context = w1 || ' ' || w2
            LEFT JOIN tot x2 ON x2.n = 2 AND x2.context = w2
            LEFT JOIN tot x1 ON x1.n = 1),
        {tag}{i + 1} AS MATERIALIZED (
            SELECT request_id, text, p.n AS n, w2 AS w1, cum.word AS w2, list_append(words, cum.word) AS words
            FROM {tag}p{i} p JOIN cum ON cum.n = k AND cum.context = ctx
            WHERE {key} % p.total >= cum.hi - cum.c AND {key} % p.total < cum.hi)""")
    return ",".join(parts)


def ngram_rounds(rounds: int) -> str:
    source = f"(SELECT *, {rounds} AS n FROM {USER_TURNS})"
    return f"WITH {TRAIN_GRAMS}, {DRAW_TABLES}, {ngram_loop(rounds, source)} {drawn_text('r', rounds)}"


def scored_tables(cap: int, tag: str = "") -> str:
    """Vocabulary and, for each of its words, the 40 that follow it most often in the training texts."""
    return f"""
    v{tag} AS MATERIALIZED ({vocabulary(cap)}),
    followed{tag} AS (
        SELECT x.idx AS a, y.idx AS b, count(*) AS c
        FROM (SELECT t[i] AS ta, t[i + 1] AS tb
              FROM (SELECT t, unnest(range(1, len(t))) AS i FROM (SELECT {STD_TOKENS} AS t FROM documents WHERE {TRAIN})))
        JOIN v{tag} x ON x.token = ta AND x.idx > 1 JOIN v{tag} y ON y.token = tb AND y.idx > 1 GROUP BY ALL),
    best{tag} AS MATERIALIZED (
        SELECT a, list(b ORDER BY c DESC, b) AS best
        FROM (SELECT * FROM followed{tag} QUALIFY row_number() OVER (PARTITION BY a ORDER BY c DESC, b) <= 40) GROUP BY a)"""


def scored_loop(rounds: int, source: str, tag: str, tables: str = "") -> str:
    """Uniform choices among the ten best allowed indexes, one CTE per round."""
    parts = [
        rf"""{tag}0 AS MATERIALIZED (
            SELECT request_id, text, n, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS ctx, []::VARCHAR[] AS words,
                   CASE WHEN idx IS NULL THEN []::INTEGER[] ELSE [idx] END AS phrase
            FROM {source} LEFT JOIN v{tables} ON token = text)"""
    ]
    tail = STD_TOKENS.replace("text", "array_to_string(ctx, ' ')")
    for i in range(rounds):
        key, other = h(f"'topk{i}'", "request_id"), h(f"'topk-random{i}'", "request_id")
        parts.append(f"""
        {tag}p{i} AS (
            SELECT r.*, list_filter(best, lambda w: NOT list_contains(phrase, w))[1:10] AS allowed
            FROM (SELECT *, ({tail})[1:10][-1] AS last FROM {tag}{i} WHERE n > {i}) r
            LEFT JOIN v{tables} k ON k.token = last AND k.idx > 1 LEFT JOIN best{tables} ON a = k.idx),
        {tag}c{i} AS (
            SELECT *, coalesce(allowed[1 + {key} % greatest(len(allowed), 1)],
                               greatest(2, {other} % (SELECT count(*) FROM v{tables})))::INTEGER AS chosen FROM {tag}p{i}),
        {tag}{i + 1} AS MATERIALIZED (
            SELECT request_id, text, n, list_append(ctx, token)[2:] AS ctx, list_append(words, token) AS words,
                   list_append(phrase, chosen) AS phrase
            FROM {tag}c{i} JOIN v{tables} ON idx = chosen)""")
    return ",".join(parts)


def scored_rounds(rounds: int) -> str:
    source = f"(SELECT *, {rounds} AS n FROM {USER_TURNS})"
    return f"""
    WITH {scored_tables(15_000)}, {scored_loop(rounds, source, "s")}
    SELECT request_id, text || ' ' || array_to_string(words, ' ') AS generated_text FROM ({finished("s", rounds)})"""


def answers() -> str:
    """All four generators for requests with their own number of words, 20 where none is given."""
    routed = f"""(SELECT request_id, text, (CASE WHEN request_id % 3 <> 0 THEN request_id % 10 + 1 ELSE 20 END)::INTEGER AS n,
                         ['baseline', 'inhouse', 'glove', 'gpt2'][1 + {h("'model'", "request_id")} % 4] AS model_used
                  FROM {USER_TURNS})"""

    def to(name: str) -> str:
        return f"(SELECT request_id, text, n FROM routed WHERE model_used = '{name}')"

    def scored(tag: str, name: str) -> str:
        return f"""SELECT request_id, text || ' ' || array_to_string(words, ' ') AS generated_text, '{name}' AS model_used
                   FROM ({finished(tag, 20)})"""

    return rf"""
    WITH routed AS MATERIALIZED (SELECT * FROM {routed}), {TRAIN_GRAMS}, {DRAW_TABLES},
    {ngram_loop(20, to("baseline"))},
    {scored_tables(15_000, "1")}, {scored_loop(20, to("inhouse"), "s", "1")},
    {scored_tables(20_000, "2")}, {scored_loop(20, to("glove"), "q", "2")}
    SELECT *, 'baseline' AS model_used FROM ({drawn_text("r", 20)})
    UNION ALL {scored("s", "inhouse")} UNION ALL {scored("q", "glove")}
    UNION ALL
    SELECT request_id, CASE WHEN w IS NULL THEN text ELSE text || repeat(' ' || w, n) END, 'gpt2'
    FROM (SELECT request_id, text, n, regexp_extract_all(text, '[^\s]+')[-1] AS w FROM {to("gpt2")})"""


def topk_rounds(rounds: int) -> str:
    """Uniform choices among the ten best allowed words, one CTE per round."""
    parts = [
        rf"""r0 AS (SELECT request_id, text, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS ctx, []::VARCHAR[] AS words
             FROM {USER_TURNS})"""
    ]
    for i in range(rounds):
        key = h(f"'topk{i}'", "request_id")
        tail = LOW_WORDPUNCT.replace("text", "array_to_string(ctx, ' ')")
        parts.append(f"""
        p{i} AS (
            SELECT r.request_id, r.text, r.ctx, r.words, coalesce(x3.best, x2.best, x1.best) AS best
            FROM (SELECT *, {tail} AS t FROM r{i}) r
            LEFT JOIN lists x3 ON x3.n = 3 AND x3.context = t[-2] || ' ' || t[-1]
            LEFT JOIN lists x2 ON x2.n = 2 AND x2.context = t[-1]
            LEFT JOIN lists x1 ON x1.n = 1),
        a{i} AS (
            SELECT request_id, text, ctx, words,
                   list_filter(best, lambda w: w <> text AND NOT list_contains(words, w))[1:10] AS allowed
            FROM p{i}),
        c{i} AS (
            SELECT request_id, text, ctx, words,
                   coalesce(allowed[1 + {key} % greatest(len(allowed), 1)],
                            (SELECT token FROM vocab WHERE idx = greatest(2,
                                {h(f"'topk-random{i}'", "request_id")} % (SELECT count(*) FROM vocab)))) AS w
            FROM a{i}),
        r{i + 1} AS (
            SELECT request_id, text, list_append(ctx, w)[2:] AS ctx, list_append(words, w) AS words FROM c{i})""")
    return f"""
    WITH {TRAIN_GRAMS},
    vocab AS ({vocabulary(15_000)}),
    lists AS MATERIALIZED (SELECT n, context, list(word ORDER BY c DESC, word) FILTER (word NOT IN ('<s>', '</s>')) AS best
              FROM grams GROUP BY ALL),
    {",".join(parts)}
    SELECT request_id, text || ' ' || array_to_string(words, ' ') AS generated_text FROM r{rounds}"""


ORACLES: dict[str, str] = {
    "save_network": vocabulary(15_000, TRAIN),
    "scan_csv": """
        SELECT doc_id::INTEGER AS id, source AS tag, n_chars::INTEGER AS views, text AS lyrics, lang AS language
        FROM documents""",
    "write_corpus": f"""
        SELECT doc_id::INTEGER AS id, source AS tag, text AS lyrics, lang AS language,
               CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS part FROM documents""",
    "write_snippets": f"SELECT snippet FROM ({SNIPPETS})",
    "read_word_vectors": f"""
        SELECT 'w' || vec_id AS word, len(embedding)::INTEGER AS dim, {MICRO.format(v='embedding')} AS vector
        FROM embeddings""",
    "corpus_audit": f"""
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL) AS null_texts,
               count(*) FILTER (WHERE text = '') AS empty_texts,
               count(*) FILTER (WHERE len(regexp_extract_all(text, {WORD})) <= 10) AS short_texts
        FROM documents""",
    "random_snippet": f"""
        WITH lines AS (SELECT row_number() OVER (ORDER BY id) - 1 AS line, snippet FROM ({SNIPPETS})),
        asked AS (SELECT request_id, {h("'line'", 'request_id')} % ((SELECT count(*) FROM documents) + 1) AS line
                  FROM {USER_TURNS})
        SELECT request_id, line, snippet FROM asked LEFT JOIN lines USING (line)""",
    "save_model": f"""
        WITH {TRAIN_GRAMS} SELECT n, count(*) AS ngrams, sum(c)::BIGINT AS tokens FROM grams GROUP BY n""",
    "prepare_corpus": """
        SELECT doc_id AS id, text, lang AS language, source AS tag FROM documents
        WHERE lang = 'en' AND source = 'src1' AND text IS NOT NULL""",
    "short_texts": f"""
        SELECT * FROM (SELECT doc_id AS id, len(regexp_extract_all(text, {WORD}))::INTEGER AS n_tokens FROM documents)
        WHERE n_tokens <= 10""",
    "lookup_by_id": """
        SELECT doc_id AS id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "split_train_test": f"""
        SELECT doc_id AS id, text, lang, source, n_chars,
               CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS part FROM documents""",
    "sample_fraction": f"""
        SELECT doc_id AS id, text, lang, source, n_chars FROM documents WHERE {h("'sample'", 'doc_id')} < 115292150460684704""",
    "sample_n_rows": f"""
        SELECT doc_id AS id, text, lang, source, n_chars FROM documents ORDER BY {h("'sample-rows'", 'doc_id')}, doc_id LIMIT 100""",
    "trial_samples": f"""
        SELECT doc_id AS id, text, lang, source, n_chars, trial::INTEGER AS trial FROM documents, range(10) r(trial)
        WHERE {h("'trial' || trial::VARCHAR", 'doc_id')} % 10 = 0""",
    "dense_id": "SELECT *, row_number() OVER (ORDER BY lang, doc_id) - 1 AS id FROM documents",
    "batch_assign": """
        SELECT *, id // 64 AS batch_id
        FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM documents)""",
    "tokenize_words": tokens_query(f"regexp_extract_all(text, {WORD})"),
    "tokenize_lower": tokens_query(f"regexp_extract_all(lower(text), {WORD})"),
    "standardize_text": f"SELECT doc_id AS id, translate(lower(text), {PUNCT}, '') AS standard FROM documents",
    "standardize_tokens": tokens_query(STD_TOKENS),
    "tokenize_wordpunct": tokens_query(LOW_WORDPUNCT),
    "tokenize_treebank": tokens_query(rf"regexp_extract_all({rewritten('text')}, '[^ \t\n\x0B\f\r]+')"),
    "learned_abbreviations": ABBREVIATIONS,
    "pad_tokens": f"""
        SELECT doc_id AS id, array_to_string(['<s>', '<s>'] || t || ['</s>', '</s>'], ' ') AS padded,
               array_to_string(['<s>', '<s>', '<s>', '<s>'] || t || ['</s>', '</s>', '</s>', '</s>'], ' ')
               AS padded_twice
        FROM (SELECT doc_id, {LOW_WORDPUNCT} AS t FROM documents)""",
    "snippets": SNIPPETS,
    "snippets_inclusive": f"""
        SELECT doc_id AS id, {join("t[s + 1 : s + 10]")} AS snippet
        FROM (SELECT doc_id, t, {h("'snippet-inclusive'", 'doc_id')} % (len(t) - 9) AS s
              FROM (SELECT doc_id, regexp_extract_all(text, {WORD}) AS t FROM documents) WHERE len(t) >= 10)""",
    "examples_random": f"""
        SELECT doc_id AS id, pos, context, next_word
        FROM ({examples(f"regexp_extract_all(text, {WORD})", source="(SELECT doc_id, text FROM documents)")})""",
    "examples_sliding": f"""
        SELECT doc_id AS id, pos::INTEGER AS pos, {join("t[pos + 1 : pos + 10]")} AS context,
               t[pos + 11] AS next_word
        FROM (SELECT doc_id, t, unnest(range(len(t) - 10)) AS pos
              FROM (SELECT doc_id, regexp_extract_all(text, {WORD}) AS t FROM documents) WHERE len(t) > 10)""",
    "encode_context": f"""
        WITH {ENCODED_15K}
        SELECT doc_id AS id, string_agg(idx::VARCHAR, ',' ORDER BY pos) AS context_ids, any_value(label) AS label
        FROM ids JOIN targets USING (doc_id) GROUP BY doc_id""",
    "train_examples_known": f"""
        WITH {ENCODED_15K}
        SELECT doc_id AS id, next_word, label FROM ex JOIN targets USING (doc_id) WHERE label <> 1""",
    "decode_tokens": f"""
        WITH {ENCODED_15K}
        SELECT idx::INTEGER AS idx, doc_id AS id, pos::INTEGER AS pos, token FROM ids JOIN vocab USING (idx)""",
    "everygrams": f"""
        WITH cut AS (
            SELECT doc_id AS id, m::INTEGER AS n, (i - 1)::INTEGER AS pos, array_to_string(t[i : i + m - 1], ' ') AS gram
            FROM (SELECT doc_id, t, m, unnest(range(1, len(t) - m + 2)) AS i
                  FROM (SELECT doc_id, ['<s>', '<s>'] || {LOW_WORDPUNCT} || ['</s>', '</s>'] AS t FROM documents), range(1, 4) r(m))),
        told AS (
            SELECT id, n, count(*) AS grams, count(DISTINCT gram) AS distinct_grams, min(gram) AS first_gram, max(gram) AS last_gram
            FROM cut GROUP BY ALL)
        SELECT cut.*, grams, distinct_grams, first_gram, last_gram
        FROM cut JOIN told ON cut.n = told.n AND cut.id IS NOT DISTINCT FROM told.id""",
    "vocabulary": vocabulary(15_000),
    "vocabulary_summaries": vocabulary(15_000),
    "vocabulary_head": f"SELECT * FROM ({vocabulary(15_000)}) ORDER BY idx LIMIT 100",
    "embedding_matrix": f"""
        SELECT idx, token, vec_id IS NOT NULL AS hit,
               {MICRO.format(v="coalesce(embedding, list_value(0.0).list_resize(64, 0.0)::FLOAT[])")} AS vector
        FROM ({vocabulary(20_000)}) LEFT JOIN embeddings ON vec_id = idx - 2""",
    "vector_coverage": f"""
        SELECT count(vec_id) AS hits, count(*) - count(vec_id) AS misses
        FROM ({vocabulary(20_000)}) LEFT JOIN embeddings ON vec_id = idx - 2""",
    "context_vectors": context_vectors("idx > 0", "greatest(known, 1)"),
    "context_vectors_unmasked": context_vectors("TRUE", "10"),
    "ngram_counts": f"WITH {ALL_GRAMS} SELECT n, context, word, c FROM grams",
    "ngram_mle": f"""
        WITH {ALL_GRAMS}
        SELECT n, context, word, round(c / sum(c) OVER (PARTITION BY n, context), 6) AS p FROM grams""",
    "next_word_argmax": f"WITH {ALL_GRAMS}, {BEST} SELECT n, context, word, c FROM best",
    "next_word_topk": f"""
        WITH {ALL_GRAMS}
        SELECT n, context, row_number() OVER (PARTITION BY n, context ORDER BY c DESC, word)::INTEGER AS rank, word, c
        FROM grams QUALIFY rank <= 10""",
    "ngram_backoff": f"""
        WITH {TRAIN_GRAMS}, asked AS ({HELD_OUT}), {BACKED_OFF},
        spread AS (SELECT n, context, sum(c)::BIGINT AS total, count(*) AS words FROM grams GROUP BY ALL)
        SELECT doc_id AS id, order_used, total, words
        FROM placed JOIN spread ON n = order_used AND spread.context = ctx""",
    "next_word_draw": drawn("c"),
    "next_word_temperature": drawn("greatest(floor(pow(c, 0.5) * 1024), 1)::BIGINT"),
    "ngram_log_loss": f"""
        WITH {TRAIN_GRAMS},
        probs AS (SELECT n, context, word, c / sum(c) OVER (PARTITION BY n, context) AS p FROM grams),
        held AS (SELECT ['<s>', '<s>'] || {LOW_WORDPUNCT} || ['</s>', '</s>'] AS t FROM documents WHERE {TEST}),
        places AS (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM held),
        asked AS (
            SELECT 1 AS n, '' AS context, t[i] AS word FROM places
            UNION ALL SELECT 2, t[i - 1], t[i] FROM places WHERE i > 1
            UNION ALL SELECT 3, t[i - 2] || ' ' || t[i - 1], t[i] FROM places WHERE i > 2)
        SELECT n, count(*) AS targets, count(*) FILTER (WHERE p IS NULL) AS zero_targets,
               round(avg(-ln(p)), 6) AS log_loss
        FROM asked LEFT JOIN probs USING (n, context, word)
        WHERE word IN (SELECT w FROM g1) GROUP BY n""",
    "ngram_predictions": f"""
        WITH {TRAIN_GRAMS}, asked AS ({HELD_OUT}), {BACKED_OFF}, {BEST}
        SELECT doc_id AS id, pos, next_word, word AS predicted, order_used, word = next_word AS correct
        FROM placed JOIN best ON best.n = order_used AND best.context = ctx""",
    "ngram_accuracy": ACCURACY + " SELECT trial, correct, total, round(accuracy, 6) AS accuracy FROM acc",
    "ngram_accuracy_drawn": f"""
        WITH chosen AS ({drawn("c")}), asked AS ({HELD_OUT}),
        told AS (
            SELECT trial, count(*) FILTER (WHERE word = next_word) AS correct, count(*) AS total
            FROM asked LEFT JOIN chosen ON id = doc_id, range(10) r(trial)
            WHERE {h("'trial' || trial::VARCHAR", 'doc_id')} % 10 = 0 GROUP BY trial)
        SELECT r.trial::INTEGER AS trial, coalesce(correct, 0) AS correct, coalesce(total, 0) AS total,
               round(correct / total, 6) AS accuracy
        FROM range(10) r(trial) LEFT JOIN told USING (trial)""",
    "accuracy_summary": ACCURACY
    + """
        SELECT count(*) AS trials, count(accuracy) AS trials_used, round(avg(accuracy), 6) AS mean_accuracy,
               round(stddev_samp(accuracy), 6) AS stddev,
               round(avg(accuracy) - 1.96 * stddev_samp(accuracy) / sqrt(count(accuracy)), 6) AS ci_low,
               round(avg(accuracy) + 1.96 * stddev_samp(accuracy) / sqrt(count(accuracy)), 6) AS ci_high
        FROM acc""",
    "accuracy_histogram": ACCURACY
    + """
        , bounds AS (SELECT min(accuracy) AS low, max(accuracy) AS high FROM acc)
        , told_bins AS (
            SELECT (CASE WHEN high = low THEN 0
                    ELSE least(floor((accuracy - low) / (high - low) * 10), 9) END)::INTEGER AS bin,
                   count(*) AS n
            FROM acc, bounds WHERE accuracy IS NOT NULL GROUP BY 1)
        SELECT b.bin::INTEGER AS bin, round(low + (high - low) * b.bin / 10, 6) AS low,
               round(low + (high - low) * (b.bin + 1) / 10, 6) AS high, coalesce(n, 0) AS n
        FROM range(10) b(bin) CROSS JOIN bounds LEFT JOIN told_bins USING (bin)""",
    "model_cost_summary": """
        WITH placed AS (SELECT event_type AS model, value, ceil(ln(value) / ln(1.01 / 0.99)) AS b FROM events),
        ordered AS (
            SELECT model, b, sum(count(*)) OVER (PARTITION BY model ORDER BY b) AS upto, sum(count(*)) OVER (PARTITION BY model) AS n
            FROM placed GROUP BY model, b),
        told AS (
            SELECT model, min(b) FILTER (WHERE upto >= ceil(n * 0.5)) AS b50, min(b) FILTER (WHERE upto >= ceil(n * 0.95)) AS b95
            FROM ordered GROUP BY model),
        means AS (SELECT model, count(*) AS runs, round(avg(value), 6) AS mean_seconds FROM placed GROUP BY model)
        SELECT model, runs, mean_seconds, round(2 * pow(1.01 / 0.99, b50) / (1.01 / 0.99 + 1), 6) AS p50_seconds,
               round(2 * pow(1.01 / 0.99, b95) / (1.01 / 0.99 + 1), 6) AS p95_seconds
        FROM means JOIN told USING (model)""",
    "accuracy_interval": f"""
        WITH {TRAIN_GRAMS}, asked AS ({HELD_OUT}), {BACKED_OFF}, {BEST},
        told AS (
            SELECT doc_id, (word = next_word)::INTEGER AS correct
            FROM placed JOIN best ON best.n = order_used AND best.context = ctx),
        cdf AS (
            SELECT sum(p) OVER (ORDER BY k) AS upto
            FROM (SELECT k, exp(-1::DOUBLE) / factorial(k::INTEGER)::DOUBLE AS p FROM range(17) t(k))),
        weighed AS (
            SELECT r, correct, {h("'resample' || r::VARCHAR", 'doc_id')} / pow(2::DOUBLE, 60) AS u FROM told, range(200) t(r)),
        sums AS (
            SELECT r, sum(w) AS n, sum(w * correct) AS k
            FROM (SELECT r, correct, (SELECT count(*) FROM cdf WHERE upto <= u) AS w FROM weighed) GROUP BY r),
        resampled AS (SELECT list_sort(list(k / n) FILTER (WHERE n > 0)) AS a FROM sums)
        SELECT (SELECT count(*) FROM told) AS rows, (SELECT round(avg(correct), 6) FROM told) AS accuracy,
               round(a[greatest(ceil(len(a) * 0.025), 1)::INTEGER], 6) AS low, round(a[greatest(ceil(len(a) * 0.975), 1)::INTEGER], 6) AS high
        FROM resampled""",
    "generate_topk": topk_rounds(10),
    "generate_ngram": ngram_rounds(10),
    "generate_scored": scored_rounds(10),
    "answer_requests": answers(),
    "answer_request_stream": answers(),
    "generate_plugin": rf"""
        SELECT request_id, CASE WHEN w IS NULL THEN text ELSE text || repeat(' ' || w, 10) END AS generated_text
        FROM (SELECT request_id, text, regexp_extract_all(text, '[^\s]+')[-1] AS w FROM {USER_TURNS})""",
    # The last known word of the context; without one, all words are equal and the first one wins.
    "score_plugin": f"""
        WITH {ENCODED_15K},
        chosen AS (SELECT doc_id, coalesce(arg_max(idx, pos) FILTER (WHERE idx > 1), 2)::INTEGER AS idx
                   FROM ids GROUP BY doc_id)
        SELECT idx, doc_id AS id, token AS predicted FROM chosen JOIN vocab USING (idx)""",
    "route_requests": f"""
        SELECT request_id, 20 AS n,
               ['baseline', 'inhouse', 'glove', 'gpt2'][1 + {h("'model'", 'request_id')} % 4] AS model_used
        FROM {USER_TURNS}""",
}
