"""SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"

_MEASURES = rf"""
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS words, string_split(text, chr(10)) AS lines FROM docs),
spans AS (SELECT doc_id, i, words[i : i + 4] AS span FROM split, unnest(range(1, len(words) - 3)) AS t(i)),
twice AS (SELECT doc_id, i FROM spans QUALIFY count(*) OVER (PARTITION BY doc_id, span) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, unnest(range(5)) AS t(d) GROUP BY doc_id),
lined AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(lines) AS line FROM split) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
measured AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
        len(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{10FFFF}}]')) AS n_letters,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (doc_id) LEFT JOIN lined USING (doc_id)
),
judged AS (
    SELECT *, n_words < 10 AS r0, 100 * n_repeat_words > 20 * n_words AS r1, 10 * n_symbols > n_words AS r2,
        n_letters >= 20 AND 2 * n_upper > n_letters AS r3, word_chars > 20 * n_words AS r4,
        n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines AS r5, n_words > 0 AND n_letters = 0 AS r6 FROM measured
)"""

ORACLES["op1_quality_ledger"] = f"""WITH {_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed,
    NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS kept,
    (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT)::BIGINT AS fail_bits
FROM judged"""

_RULES = "few_words repeated_words symbols shouting long_words repeated_lines no_letters".split()
ORACLES["quality_ablation"] = f"WITH {_MEASURES}\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (r{i}) AS rejected, count(*) FILTER (r{i} AND NOT ("
    + " OR ".join(f"r{j}" for j in range(len(_RULES)) if j != i) + ")) AS alone FROM judged"
    for i, name in enumerate(_RULES))


def _shares(name: str, rows: str, parent: str, child: str) -> str:
    """Common tables that share the budget of each parent among its children."""
    by = f"PARTITION BY {parent} " if parent else ""
    order = f"{by}ORDER BY cap / nullif(weight, 0) NULLS LAST, {child}"
    path = ", ".join(x for x in (parent, child) if x)
    return f"""
{name}_ranked AS (SELECT *, budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
    sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among FROM ({rows})),
{name}_full AS (SELECT *, weight > 0 AND cap * among <= weight * remains AS filled FROM {name}_ranked),
{name} AS (SELECT {path}, CASE WHEN filled THEN cap WHEN unfilled > 0 THEN weight * rest // unfilled ELSE 0 END AS budget
    FROM (SELECT *, budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}) AS rest,
        sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by}) AS unfilled FROM {name}_full))"""


def mixing(domain: str, seed: str, share: tuple[int, int], epochs: int, weights: dict[str, dict[str, int]]) -> str:
    case = lambda c: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights[c].items()) + " ELSE 0 END"
    level = lambda path, weight, above: (
        f"SELECT *, least(b, sum(cap) OVER ({'PARTITION BY ' + above if above else ''})) AS budget FROM (SELECT {path}, "
        f"{weight} AS weight, cap, b FROM (SELECT {path}, sum(tokens) * {epochs} AS cap FROM leaf GROUP BY {path}) ")
    return f"""WITH
leaf AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '') AS language, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS tokens FROM documents),
whole AS (SELECT sum(tokens) * {share[0]} // {share[1]} AS b FROM leaf),
{_shares("one", level("domain", case("domain"), "") + "CROSS JOIN whole)", "", "domain")},
{_shares("two", level("domain, language", case("language"), "domain") + "JOIN (SELECT domain, budget AS b FROM one) USING (domain))", "domain", "language")},
{_shares("three", level("domain, language, source", "1", "domain, language") + "JOIN (SELECT domain, language, budget AS b FROM two) USING (domain, language))", "domain, language", "source")},
plan AS (SELECT *, CASE WHEN tokens > 0 THEN least(budget // tokens, {epochs}) ELSE 0 END AS full_epochs
    FROM three JOIN (SELECT domain, language, source, sum(tokens) AS tokens FROM leaf GROUP BY ALL) USING (domain, language, source)),
placed AS (SELECT leaf.*, full_epochs, budget - full_epochs * plan.tokens AS rest, md5('{seed}|' || (full_epochs + 1)::VARCHAR || '|' || doc_id::VARCHAR) AS digest
    FROM leaf JOIN plan USING (domain, language, source)),
ordered AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY digest) AS upto FROM placed)
SELECT doc_id, domain, language, source, e::BIGINT AS epoch
FROM ordered, unnest(range(1, {epochs + 2})) AS t(e)
WHERE e <= full_epochs OR (e = full_epochs + 1 AND rest > 0 AND upto <= rest)"""


def _reach(nodes: str, links: str) -> str:
    """``reach``: the smallest id each node can reach over ``links (a, b)``, both directions given."""
    return f"""
near AS (SELECT id AS node, id AS root FROM {nodes} UNION SELECT r.a, n.root FROM {links} r JOIN near n ON r.b = n.node),
reach AS (SELECT node, min(root) AS root FROM near GROUP BY node)"""


ORACLES["op8_vector_groups"] = f"""WITH RECURSIVE
vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (SELECT x.id AS a, y.id AS b FROM vectors x JOIN vectors y ON x.id <> y.id WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
{_reach("vectors", "pairs")}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, root AS component_id, id = root AS kept
FROM vectors JOIN reach ON node = id LEFT JOIN (SELECT a, count(*) AS n FROM pairs GROUP BY a) ON a = id"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["op10_jaccard_join"] = f"""WITH RECURSIVE
split AS MATERIALIZED (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORD}') AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT id, array_to_string(w[i : i + 3], ' ') AS s
    FROM split, unnest(CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(2, len(w) - 2)) END) AS t(i)),
sizes AS MATERIALIZED (SELECT id, count(*) AS n FROM shingles GROUP BY id),
pairs AS MATERIALIZED (
    SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY ALL)
    JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b WHERE 100 * common >= 85 * (p.n + q.n - common)),
{_reach("split", "pairs")}
SELECT split.id AS doc_id, coalesce(n, 0) AS n_shingles, root AS component_id
FROM split JOIN reach ON node = split.id LEFT JOIN sizes ON sizes.id = split.id"""

ORACLES["op6_tool_links"] = """WITH RECURSIVE
asked AS (SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('system', 'user')),
calls AS (SELECT conv_id, turn, min(struct_pack(text := text, role := role)) AS c, count(*) AS n_calls FROM asked GROUP BY conv_id, turn),
answers AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
edges AS (
    SELECT DISTINCT u.conv_id, u.turn, n.turn AS needs FROM asked u JOIN calls n ON n.conv_id = u.conv_id AND n.turn < u.turn
    WHERE u.role = 'user' AND n.turn IN (u.turn - 1, u.turn - 2, 0)),
chains AS (
    SELECT conv_id, turn, 0::BIGINT AS level FROM calls
    UNION SELECT e.conv_id, e.turn, c.level + 1 FROM chains c JOIN edges e ON e.conv_id = c.conv_id AND e.needs = c.turn),
placed AS (SELECT conv_id, turn, max(level) AS level FROM chains GROUP BY conv_id, turn),
pairs AS (
    SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, 'turn-' || coalesce(c.turn, a.turn)::VARCHAR AS call_id,
        CASE c.c.role WHEN 'system' THEN 'setup' WHEN 'user' THEN 'answer' END AS name, c.turn,
        CASE WHEN n_calls > 0 THEN coalesce(p.level, 0) END AS level, a.turn + 1 AS result_turn, n_calls, n_results,
        CASE WHEN c.turn IS NULL THEN NULL WHEN c.c.text IS NULL THEN 'missing field ' || CASE c.c.role WHEN 'system' THEN 'instructions' ELSE 'prompt' END ELSE '' END AS problems,
        CASE c.c.role WHEN 'system' THEN json_object('instructions', c.c.text) WHEN 'user' THEN json_object('prompt', c.c.text, 'turn', c.turn) END AS arguments, content
    FROM calls c FULL JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.turn
    LEFT JOIN placed p ON p.conv_id = c.conv_id AND p.turn = c.turn)
SELECT conv_id, call_id, name, turn, level, result_turn, n_calls, n_results, problems, status,
    json_object('arguments', arguments, 'id', call_id, 'name', name, 'result', content, 'status', status)::VARCHAR AS json
FROM (SELECT *, CASE WHEN name IS NULL THEN 'no call' WHEN problems <> '' THEN 'invalid' WHEN n_results IS NULL THEN 'no result' ELSE 'linked' END AS status FROM pairs)"""


#: The checksum byte by byte, from the table of its polynomial.
ORACLES["op11_shards"] = """WITH RECURSIVE bits AS (
    SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) AS t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
steps AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, (len(h) // 2 + 1)::BIGINT AS size, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(h, '..'), lambda s: ('0x' || s)::BIGINT)),
        lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) AS text_crc32 FROM coded, steps),
summed AS (SELECT *, sum(size) OVER () AS total, row_number() OVER in_order AS place,
        sum(size) OVER (in_order ROWS UNBOUNDED PRECEDING) AS until FROM sized
    WINDOW in_order AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)),
cut AS (SELECT *, least(15, (2 * until - size) * 16 // (2 * total))::INT AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
    NULL::INT AS grown_shard FROM cut"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op13_divergence"] = rf"""WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
words AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
every AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
cells AS (SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, total, v FROM every JOIN kept USING (lang)
    JOIN langs USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 1)) // (total + v) AS q FROM cells),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
        FROM every AS a JOIN every AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN shares AS x ON x.lang = a.lang AND x.source = a.source
        LEFT JOIN shares AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op12_max_sketch"] = f"""WITH words AS (SELECT r, doc_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents)),
totals AS (SELECT count(DISTINCT r) AS documents, count(*) AS length FROM words),
lengths AS (SELECT r, count(*) AS n FROM words GROUP BY r),
postings AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, documents),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
wanted AS (SELECT DISTINCT item_id, text, unnest({_TERMS}) AS term FROM items),
scores AS (SELECT item_id, text, r, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 8 * (10 + 90 * n * documents // length))))::BIGINT AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals GROUP BY ALL HAVING score > 0),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INT AS rank FROM scores)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
