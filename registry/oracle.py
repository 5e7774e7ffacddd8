"""The same queries as SQL over the Parquet tables, written from the definitions.

The SQL follows the operator definitions literally (line by line cleaning, a join per look-up, plain
window ranks), not the shape of the Spark plans, so that it checks them.
"""

from __future__ import annotations

from wordloom.functions.words import STOP_WORDS

# Fixed values, written out here so that the engine's own are checked against them.
KEPT_TWO_LETTER_WORDS = ("us", "go")
NOISE_LITERALS = ("wtju", "adhd")
EMPTY_MESSAGE = "Please Enter the Text"


def _quoted(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def _chain(expr: str, *rules: tuple[str, str]) -> str:
    for pattern, replacement in rules:
        expr = f"regexp_replace({expr}, '{pattern}', '{replacement}', 'g')"
    return expr


CLEAN_LINE = _chain(
    "lower(line)",
    ("[/@|]", " "),
    ("-", " "),
    ("<>", "''"),
    (r"\. |\.$", " "),
    (r"\? |\?$", " "),
    ("! |!$", " "),
    ("<85>", " "),
    ("<92>", "''"),
    ("&", " and "),
    (r"[^\p{L}\p{N}\s''<>]", " "),
    (" www(.+) ", " "),
    (" [b-hj-z] ", " "),
)


def _lines(text: str) -> str:
    return f"list_transform(string_split_regex({text}, '\\r\\n|\\r|\\n'), lambda line: {CLEAN_LINE})"


def _tokens(text: str, outer: str) -> str:
    stripped = f"regexp_replace(w, '^{outer}+|{outer}+$', '', 'g')"
    split = f"list_transform(string_split_regex({text}, '\\s+'), lambda w: {stripped})"
    return f"list_filter({split}, lambda w: w <> '' AND NOT regexp_matches(w, '^[0-9]+$'))"


TRAIN_TOKENS = _tokens(f"array_to_string({_lines('text')}, ' ')", "[''<>]")
QUERY_TOKENS = _tokens(_chain("lower(text)", (r"[^\p{L}\p{N}\s''-]", " ")), "[''-]")

FREQ = {1: "uni_freq", 2: "bi_freq", 3: "tri_freq", 4: "tetra_freq"}


def _words(n: int) -> list[str]:
    return ["word"] if n == 1 else [f"w{i}" for i in range(1, n + 1)]


def _counts(n: int) -> str:
    picked = ", ".join(f"t[i + {k}] AS {w}" for k, w in enumerate(_words(n)))
    keys = ", ".join(_words(n))
    return (
        f"SELECT {keys}, count(*) AS {FREQ[n]} FROM (SELECT {picked} FROM positions "
        f"WHERE i + {n - 1} <= len(t)) WHERE NOT regexp_matches({_words(n)[0]}, '^[0-9]') GROUP BY {keys}"
    )


def _joined(n: int) -> str:
    """N-grams whose every word is in the dictionary, by one look-up per word."""
    joins = " ".join(f"JOIN c1 d{i} ON g.w{i} = d{i}.word" for i in range(1, n + 1))
    return f"SELECT g.* FROM c{n} g {joins}"


def _allowed(word: str) -> str:
    two = f"length({word}) = 2 AND {word} NOT IN ({_quoted(KEPT_TWO_LETTER_WORDS)})"
    return (
        f"{word} NOT IN ({_quoted(STOP_WORDS)}) AND NOT ({two}) "
        f"AND {word} NOT IN ({_quoted(NOISE_LITERALS)})"
    )


def _top(
    n: int, k: int, table: str, prob: str, extra: str = "", where: str = "true", trim: str = ""
) -> str:
    context, last = ", ".join(_words(n)[:-1]), _words(n)[-1]
    return (
        f"SELECT {context}, {last} AS word, {prob} AS prob{extra}, CAST(row_number() OVER "
        f"(PARTITION BY {context} ORDER BY {prob} DESC, {last}) AS BIGINT) AS rank FROM {table} "
        f"WHERE {_allowed(trim or last)} AND {where} QUALIFY rank <= {k}"
    )


def _discount(n: int) -> str:
    ones = f"CAST(count(*) FILTER ({FREQ[n]} = 1) AS BIGINT)"
    twos = f"CAST(count(*) FILTER ({FREQ[n]} = 2) AS BIGINT)"
    return (
        f"SELECT n1, n2, CASE WHEN n1 > 0 THEN CAST(n1 AS DOUBLE) / (CAST(n1 AS DOUBLE) "
        f"+ CAST(2 AS DOUBLE) * CAST(n2 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS discount "
        f"FROM (SELECT {ones} AS n1, {twos} AS n2 FROM j{n})"
    )



# Common table expressions: name -> (needed names, SQL).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "tokens": ((), f"SELECT doc_id, {TRAIN_TOKENS} AS t FROM documents"),
    "positions": (("tokens",), "SELECT t, unnest(range(1, len(t) + 1)) AS i FROM tokens"),
    "c1": (("positions",), _counts(1)),
    "c2": (("positions",), _counts(2)),
    "c3": (("positions",), _counts(3)),
    "c4": (("positions",), _counts(4)),
    "j2": (("c1", "c2"), _joined(2)),
    "j3": (("c1", "c3"), _joined(3)),
    "j4": (("c1", "c4"), _joined(4)),
    "p1": (
        ("c1",),
        "SELECT word, uni_freq, CAST(uni_freq AS DOUBLE) / CAST((SELECT sum(uni_freq) FROM c1) AS DOUBLE)"
        " AS uni_prob FROM c1",
    ),
    "p2": (
        ("j2", "p1"),
        "SELECT *, 0.75::DOUBLE * prob_mle + 0.25::DOUBLE * uni_prob AS smooth_mle FROM (SELECT w1, w2, "
        "bi_freq, uni_freq, uni_prob, bi_freq::DOUBLE / uni_freq::DOUBLE AS prob_mle "
        "FROM j2 JOIN p1 ON w1 = word)",
    ),
    "p3": (
        ("j3", "p2"),
        "SELECT *, 0.58::DOUBLE * tri_prob + 0.28::DOUBLE * bi_prob + 0.14::DOUBLE * uni_prob AS smooth_prob "
        "FROM (SELECT w1, w2, w3, tri_freq, bi_freq, prob_mle AS bi_prob, uni_prob, "
        "tri_freq::DOUBLE / bi_freq::DOUBLE AS tri_prob FROM j3 JOIN p2 USING (w1, w2))",
    ),
    "p4": (
        ("j4", "p3"),
        "SELECT *, 0.4::DOUBLE * tetra_prob + 0.3::DOUBLE * tri_prob + 0.2::DOUBLE * bi_prob "
        "+ 0.1::DOUBLE * uni_prob AS smooth_prob FROM (SELECT w1, w2, w3, w4, tetra_freq, tri_freq, "
        "tri_prob, bi_prob, uni_prob, tetra_freq::DOUBLE / tri_freq::DOUBLE AS tetra_prob "
        "FROM j4 JOIN p3 USING (w1, w2, w3))",
    ),
    "d2": (("j2",), _discount(2)),
    "d3": (("j3",), _discount(3)),
    "after2": (("j2",), "SELECT w1, count(*) AS n_after FROM j2 GROUP BY w1"),
    "before2": (("j2",), "SELECT w2, count(*) AS n_before FROM j2 GROUP BY w2"),
    "kn2": (
        ("p2", "d2", "after2", "before2"),
        "SELECT *, 0.75::DOUBLE * prob_kn + 0.25::DOUBLE * uni_prob AS smooth_kn FROM (SELECT w1, w2, bi_freq, "
        "uni_freq, uni_prob, prob_mle, (bi_freq::DOUBLE - discount) / uni_freq::DOUBLE "
        "+ discount / uni_freq::DOUBLE * n_after::DOUBLE * n_before::DOUBLE "
        "/ (SELECT sum(bi_freq) FROM j2)::DOUBLE AS prob_kn "
        "FROM p2 JOIN after2 USING (w1) JOIN before2 USING (w2), d2)",
    ),
    "kn2_types": (
        ("p2", "d2", "after2", "before2"),
        "SELECT w1, w2, (bi_freq::DOUBLE - discount) / uni_freq::DOUBLE "
        "+ discount / uni_freq::DOUBLE * n_after::DOUBLE * n_before::DOUBLE "
        "/ (SELECT count(*) FROM j2)::DOUBLE AS prob_kn "
        "FROM p2 JOIN after2 USING (w1) JOIN before2 USING (w2), d2",
    ),
    "types12": (("j3",), "SELECT w1, w2, count(*) AS n_w1w2 FROM j3 GROUP BY w1, w2"),
    "suffixed": (
        ("j3", "j2", "c1"),
        "SELECT a.w1, a.w2, a.w3, a.tri_freq, b.bi_freq AS w2w3_freq, u.uni_freq AS w2_freq "
        "FROM j3 a JOIN j2 b ON a.w2 = b.w1 AND a.w3 = b.w2 JOIN c1 u ON u.word = b.w1",
    ),
    "types2": (("suffixed",), "SELECT w2, count(*) AS n_w2 FROM suffixed GROUP BY w2"),
    "types3": (("suffixed",), "SELECT w3, count(*) AS n_w3 FROM suffixed GROUP BY w3"),
    "kn3": (
        ("suffixed", "types12", "types2", "types3", "j2", "d2", "d3"),
        "SELECT *, kn_part1 * kn_part2 AS prob_kn FROM (SELECT s.w1, s.w2, s.w3, s.tri_freq, j2.bi_freq, "
        "(tri_freq::DOUBLE - d3.discount) / bi_freq::DOUBLE "
        "+ d3.discount / bi_freq::DOUBLE * n_w1w2::DOUBLE AS kn_part1, "
        "(w2w3_freq::DOUBLE - d2.discount) / w2_freq::DOUBLE "
        "+ d2.discount / w2_freq::DOUBLE * n_w2::DOUBLE * n_w3::DOUBLE "
        "/ (SELECT sum(bi_freq) FROM j2)::DOUBLE AS kn_part2 "
        "FROM suffixed s JOIN j2 ON s.w1 = j2.w1 AND s.w2 = j2.w2 "
        "JOIN types12 t ON s.w1 = t.w1 AND s.w2 = t.w2 "
        "JOIN types2 ON s.w2 = types2.w2 JOIN types3 ON s.w3 = types3.w3, d2, d3)",
    ),
    "dictionary": (
        ("p1",),
        "SELECT *, CAST(row_number() OVER (ORDER BY uni_freq DESC, word) AS BIGINT) AS word_int FROM p1",
    ),
    "top2": (("p2",), _top(2, 5, "p2", "prob_mle", ", smooth_mle AS smooth_prob")),
    "top3": (("p3",), _top(3, 5, "p3", "tri_prob", ", smooth_prob")),
    "top4": (("p4",), _top(4, 5, "p4", "tetra_prob", ", smooth_prob")),
    "phrases": (
        (),
        f"SELECT conv_id * {1 << 20} + turn AS query_id, {QUERY_TOKENS} AS t "
        "FROM conversations",
    ),
}


def _with(needs: tuple[str, ...], sql: str, **extra: tuple[tuple[str, ...], str]) -> str:
    """Prefix ``sql`` with the common table expressions it needs, in order."""
    parts = {**PARTS, **extra}
    order: list[str] = []

    def visit(name: str) -> None:
        for need in parts[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({parts[name][1]})" for name in order)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def _ids(n: int, measures: str, lower: str) -> str:
    ids = ", ".join(f"d{i}.word_int AS w{i}_int" for i in range(1, n + 1))
    joins = " ".join(f"JOIN dictionary d{i} ON g.w{i} = d{i}.word" for i in range(1, n + 1))
    return f"SELECT {ids}, {measures} FROM c{n} g {joins} {lower}"


def _matches(n: int, score: str) -> str:
    on = " AND ".join(f"m.w{i} = c[{i - n}]" for i in range(1, n))
    return (
        f'SELECT query_id, CAST({n} AS BIGINT) AS "order", m.rank, m.word, m.{score} AS score '
        f"FROM ctx JOIN top{n} m ON len(c) >= {n - 1} AND {on}"
    )


def _context(max_n: int) -> tuple[tuple[str, ...], str]:
    return (("phrases",), f"SELECT query_id, t[greatest(len(t) - {max_n - 2}, 1):] AS c FROM phrases")


def _backoff(max_n: int, nth: bool = False) -> str:
    tops = tuple(f"top{n}" for n in range(2, max_n + 1))
    found = " UNION ALL ".join(_matches(n, "prob") for n in range(2, max_n + 1))
    trimmed = f"word NOT IN ({_quoted(STOP_WORDS)})"
    rank = "CAST(row_number() OVER (ORDER BY uni_freq DESC, word) AS BIGINT) AS position"
    best = f"SELECT word, uni_prob AS score, {rank} FROM p1 WHERE %s QUALIFY position %s"
    if nth:
        fallback = (
            f"SELECT 3 AS len, word, score, 1::BIGINT AS position FROM ({best % (trimmed, '= 3')}) UNION ALL "
            f"SELECT 2, word, score, 1::BIGINT FROM ({best % (trimmed, '= 2')}) UNION ALL "
            f"SELECT 1, word, score, 1::BIGINT FROM ({best % ('true', '= 2')})"
        )
    else:
        chosen = best % (trimmed if max_n == 4 else "true", "<= 3")
        fallback = f"SELECT len, b.* FROM ({chosen}) b, (SELECT unnest(range(1, {max_n})) AS len)"
    return _with(
        ("states", "kept", "fallback"),
        """
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY "order" DESC, rank) AS BIGINT)
               AS position, word, "order", score
        FROM kept JOIN states USING (query_id) WHERE n_known = n_words
        UNION ALL
        SELECT query_id, position, word, CAST(1 AS BIGINT), score FROM states JOIN fallback ON len = n_words
        WHERE n_known < n_words
        UNION ALL
        SELECT query_id, CAST(1 AS BIGINT), '%s', CAST(0 AS BIGINT), CAST(NULL AS DOUBLE)
        FROM states WHERE n_known = n_words AND query_id NOT IN (SELECT query_id FROM kept)
        """
        % EMPTY_MESSAGE,
        ctx=_context(max_n),
        found=(("ctx", *tops), found),
        kept=(
            ("found",),
            'SELECT * FROM found a WHERE (SELECT count(*) FROM found b WHERE b.query_id = a.query_id '
            'AND b."order" > a."order") < 3',
        ),
        states=(
            ("ctx", "c1"),
            "SELECT query_id, len(c) AS n_words, (SELECT count(*) FROM (SELECT unnest(c) AS w) JOIN c1 ON w = word)"
            " AS n_known FROM ctx",
        ),
        fallback=(("p1",), fallback),
    )


def _interpolated() -> str:
    found = " UNION ALL ".join(_matches(n, "smooth_prob") for n in range(2, 5))
    return _with(
        ("ctx", "ranked"),
        """
        SELECT query_id, position, word, "order", score FROM ranked
        UNION ALL
        SELECT query_id, CAST(1 AS BIGINT), '%s', CAST(0 AS BIGINT), CAST(NULL AS DOUBLE)
        FROM ctx WHERE query_id NOT IN (SELECT query_id FROM ranked)
        """
        % EMPTY_MESSAGE,
        ctx=_context(4),
        found=(("ctx", "top2", "top3", "top4"), found),
        best=(
            ("found",),
            "SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY query_id, word "
            'ORDER BY score DESC, "order" DESC) = 1',
        ),
        ranked=(
            ("best",),
            "SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, word) AS BIGINT) "
            "AS position FROM best QUALIFY position <= 5",
        ),
    )


def _looked_up(rows: str, keys: dict[str, str], table: str, value: str, name: str) -> str:
    """``rows`` with ``name``, the ``value`` that ``table`` has under the same keys (row column: table column).

    Both sides are stacked and the value is spread over the rows of its key, so that there is no join
    whose order a planner could get wrong; rows without a value are dropped, as an inner join does.
    """
    own = ", ".join(f"r.{c} AS k{i}" for i, c in enumerate(keys))
    other = ", ".join(f"{c}" for c in keys.values())
    by = ", ".join(f"k{i}" for i in range(len(keys)))
    return (
        f"SELECT r.*, {name} FROM (SELECT r, max(v) OVER (PARTITION BY {by}) AS {name} FROM ("
        f"SELECT r, {own}, NULL::DOUBLE AS v FROM ({rows}) r UNION ALL SELECT NULL, {other}, {value}::DOUBLE FROM {table})) "
        f"WHERE r IS NOT NULL AND {name} IS NOT NULL"
    )


def _select(cols: str, table: str) -> str:
    return _with((table,), f"SELECT {cols} FROM {table}")


# Words of a document that no turn of a conversation has, by a look-up per word.
UNSAID = {
    "listed": ((), f"SELECT DISTINCT unnest({TRAIN_TOKENS}) AS word FROM conversations"),
    "kept": (
        ("tokens", "listed"),
        "SELECT doc_id, coalesce(list(w ORDER BY i) FILTER (WHERE word IS NULL), []) AS kept FROM ("
        "SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM tokens) LEFT JOIN listed ON w = word "
        "GROUP BY doc_id UNION ALL SELECT doc_id, [] FROM tokens WHERE len(t) = 0",
    ),
}


# Physical lines of the documents; empty ones count.
LINES = r"SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM documents"


def oracle_sql() -> dict[str, str]:
    spoken = "doc_id, CAST(len({0}) AS BIGINT) AS n_tokens, array_to_string({0}, ' ') AS words"
    top = "SELECT * FROM ({})"
    trim_context = _allowed("w2")
    return {
        "sample_train_test": """
            WITH keyed AS (SELECT doc_id, source, md5(text) AS text_md5,
                           md5(concat_ws('~', '1234', source, doc_id)) AS key FROM documents),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id) AS r,
                       count(*) OVER (PARTITION BY source) AS n FROM keyed)
            SELECT doc_id, source, text_md5, CASE WHEN r <= 2 THEN 'test' ELSE 'train' END AS split
            FROM ranked WHERE r <= ceil(CAST(n AS DOUBLE) * CAST(0.2 AS DOUBLE))""",
        "sample_records": """
            WITH keyed AS (SELECT doc_id, source, md5(text) AS text_md5,
                           md5(concat_ws('~', '2345', source, doc_id)) AS key FROM documents)
            SELECT doc_id, source, text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id) AS r,
            count(*) OVER (PARTITION BY source) AS n FROM keyed)
            WHERE r <= ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE))""",
        "clean_text": f"SELECT doc_id, array_to_string({_lines('text')}, chr(10)) AS cleaned FROM documents",
        "tokenize": _with(("tokens",), f"SELECT {spoken.format('t')} FROM tokens"),
        "tokenize_query": _with(
            ("phrases",),
            "SELECT query_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS words, "
            "array_to_string(t[greatest(len(t) - 2, 1):], ' ') AS last_words FROM phrases",
        ),
        "ngram_strings": _with(
            ("positions",),
            "SELECT concat_ws(' ', a, b, c) AS gram, count(*) AS n, concat_ws(' ', a, b) AS prefix, "
            "concat_ws(' ', b, c) AS suffix FROM (SELECT t[i] AS a, t[i + 1] AS b, t[i + 2] AS c FROM positions "
            "WHERE i + 2 <= len(t)) GROUP BY a, b, c",
        ),
        "remove_features": _with(
            ("tokens", "listed"),
            "SELECT %s FROM (SELECT doc_id, list_filter(t, lambda w: NOT list_contains(words, w)) AS kept "
            "FROM tokens, listed)" % spoken.format("kept"),
            listed=(
                (),
                f"SELECT list(DISTINCT w) AS words FROM (SELECT unnest({TRAIN_TOKENS}) AS w FROM benchmark)",
            ),
        ),
        "remove_features_long": _with(("kept",), f"SELECT {spoken.format('kept')} FROM kept", **UNSAID),
        "blocked_bigram_counts": _with(
            ("c2",),
            "SELECT * FROM c2",
            **UNSAID,
            positions=(("kept",), "SELECT kept AS t, unnest(range(1, len(kept) + 1)) AS i FROM kept"),
        ),
        "unigram_counts": _select("*", "c1"),
        "bigram_counts": _select("*", "c2"),
        "trigram_counts": _select("*", "c3"),
        "tetragram_counts": _select("*", "c4"),
        "unigram_mle": _select("word, uni_freq, uni_prob", "p1"),
        "index_words": _select("word, uni_freq, word_int", "dictionary"),
        "bigram_mle": _select("w1, w2, bi_freq, uni_freq, uni_prob, prob_mle", "p2"),
        "trigram_mle": _select("w1, w2, w3, tri_freq, bi_freq, tri_prob", "p3"),
        "tetragram_mle": _select("w1, w2, w3, w4, tetra_freq, tri_freq, tetra_prob", "p4"),
        "bigram_interpolated": _select("w1, w2, prob_mle, uni_prob, smooth_mle", "p2"),
        "trigram_interpolated": _select("w1, w2, w3, tri_prob, bi_prob, uni_prob, smooth_prob", "p3"),
        "tetragram_interpolated": _select(
            "w1, w2, w3, w4, tetra_prob, tri_prob, bi_prob, uni_prob, smooth_prob", "p4"
        ),
        "bigram_interpolated_target": _with(
            ("p1", "p2"),
            "SELECT w1, w2, 0.75::DOUBLE * prob_mle + 0.25::DOUBLE * u AS smooth_prob FROM (%s)"
            % _looked_up("SELECT w1, w2, prob_mle FROM p2", {"w2": "word"}, "p1", "uni_prob", "u"),
        ),
        "trigram_interpolated_target": _with(
            ("p1", "p2", "p3"),
            "SELECT w1, w2, w3, 0.58::DOUBLE * tri_prob + 0.28::DOUBLE * b + 0.14::DOUBLE * u AS smooth_prob FROM (%s)"
            % _looked_up(
                _looked_up("SELECT w1, w2, w3, tri_prob FROM p3", {"w2": "w1", "w3": "w2"}, "p2", "prob_mle", "b"),
                {"w3": "word"}, "p1", "uni_prob", "u",
            ),
        ),
        "tetragram_interpolated_target": _with(
            ("p1", "p2", "p3", "p4"),
            "SELECT w1, w2, w3, w4, 0.4::DOUBLE * tetra_prob + 0.3::DOUBLE * t + 0.2::DOUBLE * b + 0.1::DOUBLE * u "
            "AS smooth_prob FROM (%s)"
            % _looked_up(
                _looked_up(
                    _looked_up(
                        "SELECT w1, w2, w3, w4, tetra_prob FROM p4",
                        {"w2": "w1", "w3": "w2", "w4": "w3"}, "p3", "tri_prob", "t",
                    ),
                    {"w3": "w1", "w4": "w2"}, "p2", "prob_mle", "b",
                ),
                {"w4": "word"}, "p1", "uni_prob", "u",
            ),
        ),
        "scaled_score": _with(
            ("top2", "top3"),
            "SELECT w1 AS context, word, prob, prob * CAST(0.2 AS DOUBLE) AS score FROM top2 UNION ALL "
            "SELECT concat_ws(' ', w1, w2), word, prob, prob * CAST(0.3 AS DOUBLE) FROM top3",
        ),
        "trim_stop_words": _with(("j2",), f"SELECT w1, w2, bi_freq FROM j2 WHERE {_allowed('w2')}"),
        "noise_words": _with(
            ("c1",),
            f"SELECT word FROM c1 WHERE (length(word) = 2 AND word NOT IN ({_quoted(KEPT_TWO_LETTER_WORDS)})) "
            f"OR word IN ({_quoted(NOISE_LITERALS)})",
        ),
        "trimmed_unigrams": _with(
            ("p1",), f"SELECT word, uni_freq, uni_prob FROM p1 WHERE word NOT IN ({_quoted(STOP_WORDS)})"
        ),
        "continuation_counts": _with(
            ("after2", "before2"),
            "SELECT coalesce(w1, w2) AS word, coalesce(n_after, 0) AS n_after, coalesce(n_before, 0) AS n_before "
            "FROM after2 FULL JOIN before2 ON w1 = w2",
        ),
        "context_types": _select("w1, w2, n_w1w2", "types12"),
        "count_of_counts": _with(
            ("j2", "j3"),
            "SELECT bi_freq AS freq, count(*) AS n_types, CAST(2 AS BIGINT) AS n FROM j2 GROUP BY 1 UNION ALL "
            "SELECT tri_freq, count(*), CAST(3 AS BIGINT) FROM j3 GROUP BY 1",
        ),
        "discounts": _with(
            ("d2", "d3"),
            "SELECT n1, n2, discount, CAST(2 AS BIGINT) AS n FROM d2 UNION ALL "
            "SELECT n1, n2, discount, CAST(3 AS BIGINT) FROM d3",
        ),
        "bigram_kn": _select("w1, w2, bi_freq, uni_freq, uni_prob, prob_mle, prob_kn", "kn2"),
        "bigram_kn_interpolated": _select("w1, w2, prob_kn, smooth_kn", "kn2"),
        "trigram_kn": _select("w1, w2, w3, tri_freq, bi_freq, kn_part1, kn_part2, prob_kn", "kn3"),
        "bigram_kn_types": _select("w1, w2, prob_kn", "kn2_types"),
        "trigram_kn_interpolated": _with(
            ("kn3", "d3", "types12"),
            "SELECT k.w1, k.w2, k.w3, (tri_freq::DOUBLE - discount) / bi_freq::DOUBLE "
            "+ discount / bi_freq::DOUBLE * n_w1w2::DOUBLE * kn_part2 AS prob_kn "
            "FROM kn3 k JOIN types12 t ON k.w1 = t.w1 AND k.w2 = t.w2, d3",
        ),
        "top5_bigram_mle": _select("w1, word, prob, rank", "top2"),
        "top5_trigram_mle": _select("w1, w2, word, prob, rank", "top3"),
        "top5_tetragram_mle": _select("w1, w2, w3, word, prob, rank", "top4"),
        "top3_bigram_interpolated": _with(("p2",), top.format(_top(2, 3, "p2", "smooth_mle"))),
        "top3_trigram_interpolated": _with(("p3",), top.format(_top(3, 3, "p3", "smooth_prob"))),
        "top5_bigram_kn": _with(("kn2",), top.format(_top(2, 5, "kn2", "prob_kn"))),
        "top5_bigram_kn_interpolated": _with(("kn2",), top.format(_top(2, 5, "kn2", "smooth_kn"))),
        "top3_trigram_mle": _with(("p3",), top.format(_top(3, 3, "p3", "tri_prob"))),
        "top3_trigram_kn": _with(("kn3",), top.format(_top(3, 3, "kn3", "prob_kn"))),
        "indexed_bigrams": _with(
            ("c2", "dictionary"),
            "SELECT a::BIGINT AS w1_int, b::BIGINT AS w2_int, bi_freq, bi_freq::DOUBLE / f AS bi_prob, f::BIGINT AS uni_freq, "
            "p AS uni_prob FROM (%s)"
            % _looked_up(
                _looked_up(
                    _looked_up(
                        _looked_up("SELECT w1, w2, bi_freq FROM c2", {"w1": "word"}, "dictionary", "word_int", "a"),
                        {"w2": "word"}, "dictionary", "word_int", "b",
                    ),
                    {"w1": "word"}, "dictionary", "uni_freq", "f",
                ),
                {"w1": "word"}, "dictionary", "uni_prob", "p",
            ),
        ),
        "indexed_trigrams": _with(
            ("c2", "c3", "dictionary"),
            _ids(
                3,
                "tri_freq, b.bi_freq, tri_freq::DOUBLE / b.bi_freq::DOUBLE AS tri_prob",
                "JOIN c2 b ON g.w1 = b.w1 AND g.w2 = b.w2",
            ),
        ),
        "indexed_tetragrams": _with(
            ("c3", "c4", "dictionary"),
            _ids(
                4,
                "tetra_freq, tetra_freq::DOUBLE / b.tri_freq::DOUBLE AS tetra_prob",
                "JOIN c3 b ON g.w1 = b.w1 AND g.w2 = b.w2 AND g.w3 = b.w3",
            ),
        ),
        "decode_words": _with(
            ("p3",), "SELECT w1, w2, w3, tri_freq, bi_freq, tri_prob FROM p3"
        ),
        "trim_first_tetragram_mle": _with(("p4",), top.format(_top(4, 5, "p4", "tetra_prob", trim="w1"))),
        "trim_context_trigram_mle": _with(
            ("p3",), top.format(_top(3, 5, "p3", "tri_prob", where=trim_context))
        ),
        "read_lines": f"SELECT line, count(*) AS n FROM ({LINES}) GROUP BY line",
        "read_corpus": f"SELECT line, count(*) AS n, count(*) AS n_ids FROM ({LINES}) GROUP BY line",
        "read_ngrams": _with(
            ("c2",),
            "SELECT w1, w2, bi_freq, 'csv' AS fmt FROM c2 UNION ALL SELECT w1, w2, bi_freq, 'parquet' FROM c2",
        ),
        "read_word_list": f"SELECT DISTINCT unnest({TRAIN_TOKENS}) AS word, 1::BIGINT AS n FROM conversations",
        "load_model": _select("w1, word, prob, rank", "top2"),
        "context_key": _with(
            ("c3",), "SELECT w1, w2, count(*) AS n_types, sum(tri_freq)::BIGINT AS freq FROM c3 GROUP BY w1, w2"
        ),
        "predict_backoff_trigram": _backoff(3),
        "predict_backoff_tetragram": _backoff(4),
        "predict_backoff_nth": _backoff(4, nth=True),
        "predict_interpolated": _interpolated(),
    }
