"""DuckDB SQL for the operators that SQL can express on whole tables.

Sharding by differencing, MinHash links, learned scores, tokenizers, leftmost
pattern searches, fitted rates, line components and windows of turns have no such form;
their tests compare them with plain single-process versions.
"""

from __future__ import annotations

import math

from stratum.llm.quality import RUNGS, QualityParams, sketched_names

_SPACES = r"[\x20\x09-\x0D]"
_NOT_SPACE = r"[^\x20\x09-\x0D]"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _item_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_UPPER}, lower({_UPPER})), '{_ITEM_WORD}')"


DECONTAMINATE = f"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_item_words('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, least(len(w), 13) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0) a),
docs AS (SELECT doc_id, {_item_words('text')} AS w FROM documents),
places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM docs, (SELECT DISTINCT size FROM windows) s WHERE len(w) >= size),
hits AS (
  SELECT DISTINCT p.doc_id, p.i, p.size, w.item
  FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM places) p
  JOIN windows w ON p.win = w.win AND p.size = w.size),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) c GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""


def quality_sql(params: QualityParams = QualityParams()) -> str:
    ratios = {
        "symbol_ratio": ("n_symbols", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "repeat_ratio": ("n_repeat_words", "n_words"), "mean_word_len": ("word_chars", "n_words"),
        "n_words": ("n_words", "1"), "n_lines": ("n_lines", "1"),
    }
    sketched = sketched_names(params)
    names = ", ".join(f"'{x}'" for x in sketched)
    values = ", ".join("CASE WHEN {1} > 0 THEN CAST({0} AS DOUBLE) / CAST({1} AS DOUBLE) ELSE 0.0 END".format(*ratios[x]) for x in sketched)
    value = f"CASE WHEN {{0}} = -1073741824 THEN 0.0 ELSE 2 * pow({params.gamma!r}, {{0}}) / ({params.gamma!r} + 1) END"
    ladders = {"up": RUNGS, "down": [round(1 - p, 6) for p in RUNGS]}
    columns = [(f"{way}{k}", p) for way, ps in ladders.items() for k, p in enumerate(ps)]

    def level(name: str, keys: str) -> str:
        by = f"{keys}, metric" if keys else "metric"
        quantiles = ", ".join(f"{value.format(f'min(b) FILTER (upto >= ceil(total * {p!r}))')} AS {c}" for c, p in columns)
        return (
            f"{name} AS (SELECT {by}, max(total) AS total, {quantiles} FROM ("
            f"SELECT {by}, b, sum(n) OVER (PARTITION BY {by} ORDER BY b) AS upto, sum(n) OVER (PARTITION BY {by}) AS total "
            f"FROM (SELECT {by}, b, sum(n) AS n FROM sketch GROUP BY ALL) x) y GROUP BY {by})"
        )

    def pick(c: str) -> str:
        return f"CASE WHEN s.total >= {params.min_group} THEN s.{c} WHEN g.total >= {params.min_group} THEN g.{c} ELSE o.{c} END AS {c}"

    def climbed(source: str, way: str, sign: str) -> str:
        """Columns fence_<way> and open_<way>, a nested query a rung."""

        def step(k: int) -> str:
            here, before = f"{way}{k}", f"{way}{k - 1}"
            noise = (
                f"CASE WHEN unit IS NULL THEN {here} * ({params.gamma!r} - 1) ELSE {params.reach!r} * unit "
                f"* sqrt(greatest({here} * size / unit, 1.0)) / greatest(size, 1.0) END"
            )
            return f"{here} {sign} greatest({params.reach!r} * abs({here} - {before}), {noise})"

        source = f"(SELECT *, {step(1)} AS fence_{way}, true AS open_{way} FROM {source} l1{way})"
        for k in range(2, len(RUNGS)):
            reached = f"open_{way} AND {way}{k} {'<=' if sign == '+' else '>='} fence_{way}"
            source = (
                f"(SELECT * REPLACE (CASE WHEN {reached} THEN {step(k)} ELSE fence_{way} END AS fence_{way}, "
                f"{reached} AS open_{way}) FROM {source} l{k}{way})"
            )
        return source

    metrics = ", ".join(
        f"('{m.name}', '{m.of}', {'CAST(NULL AS DOUBLE)' if m.unit is None else float(m.unit)!r}, {str(m.two_sided).lower()})" for m in params.metrics
    )
    fences = climbed(climbed("chosen", "up", "+"), "down", "-")
    return f"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_NOT_SPACE}+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_NOT_SPACE}')) AS l FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3) a) b),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS place FROM windows WHERE n > 1) c GROUP BY doc_id),
m AS (
  SELECT b.doc_id, lang, source, len(w) AS n_words, length(regexp_replace(text, '{_SPACES}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words FROM base b LEFT JOIN repeated r ON b.doc_id = r.doc_id),
judged AS (
  SELECT *, n_words < {params.min_words} OR 100 * n_repeat_words > {params.max_repeat_percent} * n_words AS base_failed FROM m),
long AS (SELECT doc_id, lang, source, base_failed, unnest([{names}]) AS metric, unnest([{values}]) AS v FROM judged),
sketch AS (
  SELECT lang, source, metric, CASE WHEN v = 0 THEN -1073741824 ELSE CAST(ceil(ln(v) / {math.log(params.gamma)!r}) AS INTEGER) END AS b,
    count(*) AS n FROM long WHERE NOT base_failed GROUP BY ALL),
{level('by_source', 'lang, source')}, {level('by_lang', 'lang')}, {level('overall', '')},
quantiles AS (
  SELECT s.lang, s.source, s.metric, {', '.join(pick(c) for c, _ in columns)}
  FROM by_source s JOIN by_lang g ON s.metric = g.metric AND s.lang IS NOT DISTINCT FROM g.lang JOIN overall o ON s.metric = o.metric),
metrics AS (SELECT * FROM (VALUES {metrics}) f(metric, size_of, unit, two_sided)),
chosen AS (
  SELECT q.*, unit, two_sided, z.up0 AS size FROM quantiles q JOIN metrics f ON q.metric = f.metric
  JOIN quantiles z ON z.metric = f.size_of AND z.lang IS NOT DISTINCT FROM q.lang AND z.source IS NOT DISTINCT FROM q.source),
fences AS (SELECT * FROM {fences} x),
odd AS (
  SELECT x.doc_id, bool_or(v > fence_up OR (two_sided AND v < fence_down)) AS odd
  FROM long x JOIN fences q ON x.metric = q.metric AND x.lang IS NOT DISTINCT FROM q.lang AND x.source IS NOT DISTINCT FROM q.source
  GROUP BY x.doc_id)
SELECT m.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, NOT base_failed AND NOT coalesce(odd, false) AS kept
FROM judged m LEFT JOIN odd o ON m.doc_id = o.doc_id
"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_UPPER}, lower({_UPPER})), '{_TERM}')"


RANKED_SEARCH = f"""
WITH d AS (SELECT doc_id, {_terms('text')} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d),
q AS (SELECT DISTINCT item_id, unnest({_terms('text')}) AS t FROM benchmark),
tf AS (
  SELECT doc_id, size, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS size, unnest(w) AS t FROM d) a
  WHERE t IN (SELECT t FROM q) GROUP BY ALL),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t) x, s),
scored AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN weights ON q.t = weights.t JOIN tf ON q.t = tf.t, s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

#: CRC-32 of the decimal form of ``c``: a byte, then seven zeros, are shifted in bit by bit.
_CRC32 = (
    "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), "
    "lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"
)

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, max(nth) AS own FROM t GROUP BY c),
hashed AS (SELECT c, own, c - c % 100 AS base, {_CRC32} % 6 AS h FROM own),
convs AS (
  SELECT x.c, x.own, x.base, x.h, least(x.h, coalesce(b.own, 0)) AS taken
  FROM hashed x LEFT JOIN own b ON x.base = b.c),
turns AS (
  SELECT t.c, nth - h + taken AS place, role, text FROM t JOIN convs ON t.c = convs.c WHERE nth > h
  UNION ALL SELECT convs.c, nth, role, text FROM convs JOIN t ON t.c = base AND nth <= h),
paths AS (
  SELECT c, 0 AS d, '' AS k, 0 AS chars FROM convs
  UNION ALL SELECT c, place, md5(string_agg(md5(role) || md5(text), '') OVER (
    PARTITION BY c ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), length(text) FROM turns),
stepped AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS is_end FROM paths),
nodes AS (
  SELECT d, k, min(up) AS up, min(c) AS c, count(*) AS n, min(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends FROM stepped GROUP BY d, k),
families AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
every AS (SELECT x.*, coalesce(f.n, 0) AS n_children FROM nodes x LEFT JOIN families f ON x.d = f.d AND x.k = f.k),
below AS (
  SELECT p.d, p.k, count(*) FILTER (y.n_children = 0) AS n_leaves, sum((y.n - 1) * y.chars) AS saved
  FROM every y JOIN paths p ON p.c = y.c AND p.d <= y.d GROUP BY p.d, p.k)
SELECT e.c AS conv_id, CAST(e.d AS BIGINT) AS depth, u.c AS parent_conv_id, CAST(e.n AS BIGINT) AS n_convs,
  CAST(e.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  e.ends AS ends_sha256
FROM every e JOIN below b ON e.d = b.d AND e.k = b.k LEFT JOIN nodes u ON u.d = e.d - 1 AND u.k = e.up
"""

ORACLE = {"op5_decontaminate": DECONTAMINATE, "op10_quality_rules": quality_sql(), "op11_ranked_search": RANKED_SEARCH, "op12_prefix_trie": PREFIX_TRIE}
