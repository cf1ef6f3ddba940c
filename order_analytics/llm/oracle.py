"""The queries of the subpackage that SQL can express, in DuckDB's dialect.

Not here: encoding (its merges), fingerprints (their hash), packing and sharding (greedy), the vector tree
(approximate) and the pipeline (it has stages of these). Tests hold those against plain versions.
"""

from __future__ import annotations

from order_analytics.llm import backoff_lm, byte_dedup, repetition, word_dedup

WORD = r"[^\x20\x09-\x0D]+"

#: Each word of each document with its place.
WORDS = rf"""
    lists AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS list FROM documents),
    words AS (SELECT doc_id, unnest(list) AS word, unnest(range(len(list))) AS place FROM lists)"""


def _backoff_lm() -> str:
    backoff = backoff_lm.BACKOFF
    return f"""
WITH {WORDS},
pairs AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS lead FROM words),
counts AS (
    SELECT doc_id, lead, place,
        count(*) OVER (PARTITION BY word) - count(*) OVER (PARTITION BY doc_id, word) AS of_word,
        count(*) OVER (PARTITION BY lead, word) - count(*) OVER (PARTITION BY doc_id, lead, word) AS of_pair,
        greatest(count(*) OVER () - count(*) OVER (PARTITION BY doc_id), 1) AS others
    FROM pairs
),
single AS (SELECT *, CASE WHEN of_word > 0 THEN of_word / others ELSE {backoff} / others END AS alone,
    lag(of_word) OVER (PARTITION BY doc_id ORDER BY place) AS of_lead FROM counts),
scores AS (
    SELECT doc_id, CASE WHEN lead IS NULL THEN alone WHEN of_pair > 0 THEN of_pair / of_lead ELSE {backoff} * alone END AS score
    FROM single
),
sums AS (SELECT doc_id, count(*) AS n_words, sum(ln(score)) AS total FROM scores GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(total, 0.0), 4) AS log_score, round(total / n_words, 4) AS mean_log
FROM documents d LEFT JOIN sums USING (doc_id)"""


def _repetition_rules() -> str:
    lengths = sorted({repetition.BASE_WINDOW, *repetition.COVERAGE_PERCENT})
    grams = ", ".join(
        "CASE WHEN lead(word, {1}) OVER text IS NOT NULL THEN concat_ws(' ', {0}) END AS gram_{2}".format(
            ", ".join(f"lead(word, {k}) OVER text" for k in range(n)), n - 1, n
        )
        for n in lengths
    )
    twice = ", ".join(f"gram_{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram_{n}) > 1 AS twice_{n}" for n in lengths)
    covered = ", ".join(
        f"bool_or(twice_{n}) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS in_{n}"
        for n in lengths
    )
    chars = ", ".join(f"coalesce(sum(length(word)) FILTER (in_{n}), 0)::BIGINT AS dup_chars_{n}" for n in repetition.COVERAGE_PERCENT)
    names = ", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in repetition.COVERAGE_PERCENT)
    passed = " AND ".join(f"100 * dup_chars_{n} <= {percent} * word_chars" for n, percent in repetition.COVERAGE_PERCENT.items())
    failed = f"(n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > {repetition.REPEAT_PERCENT} * n_words)"
    return f"""
WITH {WORDS},
grams AS (SELECT *, {grams} FROM words WINDOW text AS (PARTITION BY doc_id ORDER BY place)),
marked AS (SELECT *, {twice} FROM grams),
covered AS (SELECT *, {covered} FROM marked),
counted AS (
    SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
        count(*) FILTER (in_{repetition.BASE_WINDOW}) AS n_repeat_words, {chars}
    FROM covered GROUP BY doc_id
),
pieces AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM pieces),
repeats AS (
    SELECT doc_id, length(array_to_string(regexp_extract_all(line, '{WORD}'), '')) AS chars,
        row_number() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS again
    FROM lines WHERE regexp_matches(line, '{WORD}')
),
by_line AS (
    SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(chars) FILTER (again), 0)::BIGINT AS dup_line_chars
    FROM repeats GROUP BY doc_id
),
measures AS (
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, {names},
        coalesce(dup_line_chars, 0) AS dup_line_chars
    FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN by_line USING (doc_id)
)
SELECT *, {failed} AS base_failed,
    NOT {failed} AND {passed} AND 100 * dup_line_chars <= {repetition.LINE_PERCENT} * word_chars AS kept
FROM measures"""


def _byte_dedup() -> str:
    length = byte_dedup.LENGTH
    return f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
bytes AS (
    SELECT doc_id, place, substr(digits, 2 * place + 1, 2) AS digit,
        CASE WHEN 2 * (place + {length}) <= length(digits) THEN md5_number(substr(digits, 2 * place + 1, {2 * length})) END AS string
    FROM (SELECT *, unnest(range(length(digits) // 2)) AS place FROM texts)
),
repeats AS (
    SELECT *, string IS NOT NULL AND row_number() OVER (PARTITION BY string ORDER BY doc_id, place) > 1 AS again FROM bytes
),
covered AS (
    SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS gone
    FROM repeats
),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS opens FROM covered),
sums AS (
    SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
        sha256(unhex(coalesce(string_agg(digit, '' ORDER BY place) FILTER (NOT gone), ''))) AS kept_sha256
    FROM edges GROUP BY doc_id
)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN sums USING (doc_id)"""


def _word_dedup() -> str:
    length = word_dedup.LENGTH
    return f"""
WITH {WORDS},
windows AS (
    SELECT doc_id, place, array_to_string(list[place + 1 : place + {length}], ' ') AS window_words
    FROM (SELECT *, unnest(range(len(list) - {length - 1})) AS place FROM lists)
),
repeats AS (
    SELECT doc_id, place, min(doc_id) OVER (PARTITION BY window_words) < doc_id AS again FROM windows
),
marked AS (SELECT words.*, coalesce(again, false) AS again FROM words LEFT JOIN repeats USING (doc_id, place)),
covered AS (
    SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS gone
    FROM marked
),
sums AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
        sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN sums USING (doc_id)"""


def _warc_revisits() -> str:
    # each hexadecimal digit is four bits, each five bits are one base-32 digit
    return """
WITH pages_of AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT *, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS original FROM pages_of),
bits AS (
    SELECT *, list_aggregate(list_transform(range(1, 41), lambda k: right(bin(strpos('0123456789abcdef', substr(digest, k, 1)) + 15), 4)), 'string_agg', '') AS bits
    FROM digests
)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * substr(bits, 5 * k + 1, 1)::INT + 8 * substr(bits, 5 * k + 2, 1)::INT + 4 * substr(bits, 5 * k + 3, 1)::INT
        + 2 * substr(bits, 5 * k + 4, 1)::INT + substr(bits, 5 * k + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM bits"""


def _crc32(text: str) -> str:
    """Bit by bit; 256 stands for a shift by one bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))"
    step = "CASE WHEN s < 256 THEN xor(c, s) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, s: {step}), 4294967295)"


#: Levels that the manifest's SQL has: more than enough for the tables it is run on.
LEAF_LEVELS, GROUP_LEVELS = 7, 3


def _climbed(nodes: str, rows: str, name: str, levels: int) -> str:
    """From ``nodes(tree, place, node)`` and ``rows(..., tree, place, cur, proof)``: <name>_rows at the top, and <name>_top (tree, node)."""
    parts, below, held = [], nodes, rows
    for level in range(levels):
        runs, above, moved = f"{name}_runs_{level}", f"{name}_nodes_{level}", f"{name}_rows_{level}"
        left, right = "array_to_string(nodes[1 : (place % 8)::INT], '')", "array_to_string(nodes[(place % 8)::INT + 2 :], '')"
        parts.append(f"""
{runs} AS (
    SELECT tree, place // 8 AS run, list(node ORDER BY place) AS nodes, any_value(size) AS size
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {below}) GROUP BY tree, place // 8
),
{above} AS (SELECT tree, run AS place, CASE WHEN size = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node FROM {runs}),
{moved} AS (
    SELECT r.* REPLACE (place // 8 AS place, CASE WHEN size = 1 THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
        CASE WHEN size = 1 THEN proof ELSE proof || {left} || {right} END AS proof)
    FROM {held} r JOIN {runs} u ON r.tree = u.tree AND r.place // 8 = u.run
)""")
        below, held = above, moved
    return ",".join(parts) + f", {name}_top AS (SELECT tree, node FROM {below}), {name}_rows AS (SELECT * FROM {held})"


def _merkle_manifest() -> str:
    def leaf(names: list[str]) -> str:
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({name}::VARCHAR)) || ':' || {name}::VARCHAR, '-')" for name in names) + ")"

    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf(fields)} AS node, {leaf([*fields[:-1], lowered])} AS changed,
        coalesce({_crc32("doc_id::VARCHAR")} % 3 = 0, false) AS tampered
    FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS place FROM leaves),
claims AS (SELECT doc_id, node AS leaf, tree, place, CASE WHEN tampered THEN changed ELSE node END AS cur, '' AS proof FROM placed),
{_climbed("placed", "claims", "leaf", LEAF_LEVELS)},
groups AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, tree AS name, node FROM leaf_top),
members AS (
    SELECT doc_id, leaf, g.node AS subroot, g.tree, g.place, cur, proof FROM leaf_rows r JOIN groups g ON r.tree = g.name
),
{_climbed("groups", "members", "group", GROUP_LEVELS)}
SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.node AS verified
FROM group_rows r JOIN group_top t ON r.tree = t.tree"""


def _shallot_clustering() -> str:
    parts = ["""
kept AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
starts AS (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS number FROM kept),
centres_0 AS (SELECT number, v FROM starts WHERE number < 40)"""]
    apart = "list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT"
    for number in range(6):
        parts.append(f"""
ways_{number} AS (SELECT vec_id, k.v AS v, number, {apart} AS distance FROM kept k, centres_{number} c),
assigned_{number} AS (
    SELECT * FROM ways_{number} QUALIFY row_number() OVER (PARTITION BY vec_id, v ORDER BY distance, number) = 1
)""")
        if number < 5:
            parts.append(f"""
sums_{number} AS (
    SELECT number, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
    FROM (SELECT number, unnest(v) AS x, unnest(range(1, 65)) AS i FROM assigned_{number}) GROUP BY number, i
),
means_{number} AS (SELECT number, list(x ORDER BY i) AS v FROM sums_{number} GROUP BY number),
centres_{number + 1} AS (SELECT c.number, coalesce(m.v, c.v) AS v FROM centres_{number} c LEFT JOIN means_{number} m ON c.number = m.number)""")
    return f"""
WITH {",".join(parts)}
SELECT vec_id, a.number::INT AS "cluster", distance, sum(distance) OVER (PARTITION BY a.number)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM assigned_5 a JOIN centres_5 c ON a.number = c.number"""


def _secret_scan() -> str:
    def either(word: str) -> str:
        return "".join(f"[{letter.upper()}{letter}]" if letter.isalpha() else letter for letter in word)

    words = "|".join(either(word).replace("_", "_?") for word in ("password", "passwd", "secret", "token", "api_key"))
    value = "[A-Za-z0-9+/_.=-]"
    opening = f"({words})[\"'']?\\x20*[:=]\\x20*[\"'']?"
    # a token may be followed by no letter or digit; that character is then part of the match, but of no other token
    patterns = {
        "assign": f"{opening}{value}+",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
        "forge": "gh[pousr]_[0-9A-Za-z]{36}([^0-9A-Za-z]|$)",
        "package": "npm_[0-9A-Za-z]{36}([^0-9A-Za-z]|$)",
    }
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value_of = _crc32("substr(found, 5, 30)")
    checksum = " || ".join(f"substr('{digits}', 1 + ({value_of} // {62 ** (5 - k)} % 62)::INT, 1)" for k in range(6))
    token = f"substr(found, 35, 6) = {checksum}"
    holds = {
        "assign": f"length(regexp_replace(found, '^{opening}', '')) >= 8",
        "access": "length(found) >= 16",
        "hex": "length(found) >= 32",
        "forge": token,
        "package": token,
    }
    parts = []
    for number, (kind, pattern) in enumerate(patterns.items()):
        length = "40" if kind in ("forge", "package") else "length(found)"
        parts.append(f"""
{kind}_lists AS (
    SELECT row, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM texts
),
{kind}_gaps AS (SELECT row, unnest(found) AS found, unnest(gaps[1 : len(found)]) AS gap, unnest(range(len(found))) AS place FROM {kind}_lists),
{kind}_placed AS (
    SELECT row, found, sum(length(gap) + length(found)) OVER (PARTITION BY row ORDER BY place) - length(found) AS start FROM {kind}_gaps
),
{kind}_finds AS (
    SELECT row, {number} AS number, '{kind}' AS kind, start::BIGINT AS start, (start + {length})::BIGINT AS stop FROM {kind}_placed WHERE {holds[kind]}
)""")
    every = " UNION ALL ".join(f"SELECT * FROM {kind}_finds" for kind in patterns)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in ("assign", "access", "hex"))
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
{",".join(parts)},
finds AS ({every}),
sums AS (SELECT row, {counts}, {listed} FILTER (number < 3) AS base, {listed} AS spans FROM finds GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN sums USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_backoff_lm": _backoff_lm(),
        "op3_suffix_array_dedup": _byte_dedup(),
        "op4_repetition_rules": _repetition_rules(),
        "op5_suffix_tree_dedup": _word_dedup(),
        "op8_warc_revisits": _warc_revisits(),
        "op11_merkle_manifest": _merkle_manifest(),
        "op12_shallot_clustering": _shallot_clustering(),
        "op13_secret_scan": _secret_scan(),
    }
