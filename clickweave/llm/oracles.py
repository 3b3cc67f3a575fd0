"""DuckDB SQL of the queries that SQL can express."""

LLM_ORACLES: dict[str, str] = {}

LLM_ORACLES["op8_line_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

LLM_ORACLES["op9_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL
         AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine
  FROM embeddings),
links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS id FROM v a JOIN v b
  ON a.label = b.label AND a.fine AND b.fine AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.93 ELSE false END),
reach(r, other) AS (SELECT r, r FROM v UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.other = links.a),
comp AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.other GROUP BY reach.r),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, comp.component_id, coalesce(v.vec_id = comp.component_id, false) AS kept
FROM v JOIN comp ON comp.r = v.r LEFT JOIN n ON n.a = v.r
"""


def _share(level: str, parent: str, keys: str, parents: str) -> str:
    """The nodes of ``level`` with their budgets, from their parents' in ``parent``."""
    last = keys.split(", ")[-1]
    order = f"ORDER BY room / weight, {last} NULLS FIRST"
    part = f"PARTITION BY {parents}" if parents else ""
    same = " AND ".join(f"n.{k} IS NOT DISTINCT FROM p.{k}" for k in parents.split(", ")) if parents else "true"
    return f"""
b{level}_nodes AS (SELECT n.*, p.budget::HUGEINT AS pb FROM r{level} n JOIN {parent} p ON {same}),
b{level}_full AS (
  SELECT *, room::HUGEINT * sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         <= (pb - coalesce(sum(room) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS fl
  FROM b{level}_nodes),
b{level}_rest AS (
  SELECT *, pb - sum(CASE WHEN fl THEN room ELSE 0 END) OVER ({part}) AS lft,
         sum(CASE WHEN fl THEN 0 ELSE weight END) OVER ({part}) AS opn,
         sum(CASE WHEN fl THEN 0 ELSE weight END) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached
  FROM b{level}_full),
b{level} AS (
  SELECT {keys}, CASE WHEN fl THEN room ELSE (reached * lft) // opn - ((reached - weight) * lft) // opn END AS budget
  FROM b{level}_rest),"""


def mixing_sql(domains: int, weights: dict, max_epochs: int, seed: int, source: str = "documents") -> str:
    """The whole mixture in SQL: rooms upward, budgets downward, then the epochs in one window a leaf."""
    keys = {1: "dom", 2: "dom, lang", 3: "dom, lang, source"}

    def given(depth: int) -> str:
        rows = [p + (w,) for p, w in weights.items() if len(p) == depth]
        return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)

    def rooms(depth: int, below: str) -> str:
        ks = keys[depth].split(", ")
        same = " AND ".join(f"n.{k} IS NOT DISTINCT FROM w.{k}" for k in ks)
        return f"""
r{depth} AS (
  SELECT {', '.join('n.' + k for k in ks)},
         CASE WHEN coalesce(any_value(w.weight), 1) > 0 THEN sum(n.room) ELSE 0 END AS room,
         greatest(coalesce(any_value(w.weight), 1), 1) AS weight
  FROM {below} n LEFT JOIN (VALUES {given(depth)}) w({keys[depth]}, weight) ON {same}
  GROUP BY {', '.join('n.' + k for k in ks)}),"""

    return rf"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) <> ''
              THEN 'd' || (right(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), 6)::BIGINT % {domains}) END AS dom
  FROM {source}),
leaves AS (SELECT dom, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {max_epochs} AS room FROM docs GROUP BY ALL),
{rooms(3, 'leaves')}{rooms(2, 'r3')}{rooms(1, 'r2')}
top AS (SELECT least((SELECT sum(room) FROM r1), (SELECT sum(tokens) FROM leaves)) AS budget),
{_share('1', 'top', keys[1], '')}{_share('2', 'b1', keys[2], keys[1])}{_share('3', 'b2', keys[3], keys[2])}
plan AS (
  SELECT l.*, b.budget, b.budget // l.tokens AS whole, b.budget % l.tokens AS rest
  FROM leaves l JOIN b3 b ON l.dom IS NOT DISTINCT FROM b.dom AND l.lang IS NOT DISTINCT FROM b.lang
       AND l.source IS NOT DISTINCT FROM b.source WHERE b.budget > 0),
planned AS (
  SELECT d.*, p.budget, p.whole, p.rest,
         sum(d.n_tokens) OVER (PARTITION BY d.dom, d.lang, d.source
           ORDER BY md5('{seed}:' || p.whole || ':' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST, d.t) - d.n_tokens AS start
  FROM docs d JOIN plan p ON d.dom IS NOT DISTINCT FROM p.dom AND d.lang IS NOT DISTINCT FROM p.lang
       AND d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, lang, source, unnest(range(0, whole::BIGINT + CASE WHEN start < rest THEN 1 ELSE 0 END)) AS epoch,
       n_tokens::BIGINT AS n_tokens, budget::BIGINT AS leaf_budget
FROM planned
"""

#: crc32 by its own table: 256 numbers from eight halving steps each, then one lookup a byte.
_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT] || range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
crcs AS (
  SELECT w, xor(list_reduce([4294967295] || list_transform(range(strlen(w)),
           lambda i: 16 * (strpos('0123456789ABCDEF', substr(hex(w), 2 * i + 1, 1)) - 1)
                     + strpos('0123456789ABCDEF', substr(hex(w), 2 * i + 2, 1)) - 1),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM words_once, crc_table)"""

LLM_ORACLES["op13_importance"] = rf"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
target_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
held AS (SELECT r, unnest(ws) AS w FROM doc_words),
words_once AS (SELECT w FROM held UNION SELECT w FROM target_words),{_CRC},
s AS (SELECT crc % 10000 AS b, count(*) AS n FROM held JOIN crcs USING (w) GROUP BY 1),
t AS (SELECT crc % 10000 AS b, count(*) AS n FROM target_words JOIN crcs USING (w) GROUP BY 1),
sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS sa, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS ta),
gain AS (
  SELECT s.b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sa + 10000) / ((s.n + 1)::DOUBLE * (ta + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t ON s.b = t.b, sums),
weights AS (SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM held JOIN crcs USING (w) JOIN gain ON gain.b = crc % 10000 GROUP BY r),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                     / 4294967296))))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (WHERE n_features >= 20) OVER () AS enough FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * enough // 100 THEN place END AS rank
FROM ranked
"""


def licenses_sql(threshold: float, source: str = "documents") -> str:
    """Every block of every text against every template, without filters."""
    from clickweave.llm.licenses import NOTICES, PHRASES, templates_of

    def words(values: list[str]) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    templates = templates_of(PHRASES, NOTICES, threshold)
    rows = ", ".join(f"({i}, '{t.label}', {words(t.tokens)}, {t.need}, {t.stride})" for i, t in enumerate(templates) if not t.phrase)
    phrases = ", ".join(f"('{t.label}', {words(t.words)})" for t in templates if t.phrase)
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM {source}),
phrases(label, ps) AS (VALUES {phrases}),
places AS (
  SELECT r, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1 : i + len(ps)] = ps)) AS place FROM docs, phrases),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
notices(id, label, ts, need, stride) AS (VALUES {rows}),
blocks AS (
  SELECT r, stride, start, list_distinct(ws[start + 1 : start + 2 * stride]) AS b
  FROM (SELECT r, ws, stride, unnest(range(0, len(ws), stride)) AS start FROM docs, (SELECT DISTINCT stride FROM notices))),
held AS (
  SELECT r, b.stride, start, id, label, list_intersect(ts, b) AS h, len(ts) AS n FROM blocks b JOIN notices t ON b.stride = t.stride
  WHERE len(list_intersect(ts, b)) >= need),
own AS (
  SELECT * FROM held x WHERE NOT EXISTS (
    SELECT 1 FROM held u WHERE u.r = x.r AND u.stride = x.stride AND u.start = x.start AND len(u.h) > len(x.h)
    AND list_has_all(u.h, x.h))),
all_labels AS (SELECT r, label FROM own UNION SELECT r, label FROM places),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM all_labels GROUP BY r),
best AS (SELECT r, max(len(h)::DOUBLE / n) AS score FROM own GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN named USING (r) LEFT JOIN best USING (r)
"""


LLM_ORACLES["op11_licenses"] = licenses_sql(0.8)


def _add_mixing() -> None:
    from clickweave.llm.queries import MIX_DOMAINS, MIX_SEED, MIX_WEIGHTS

    LLM_ORACLES["op1_mixing"] = mixing_sql(MIX_DOMAINS, MIX_WEIGHTS, 4, MIX_SEED)


_add_mixing()
