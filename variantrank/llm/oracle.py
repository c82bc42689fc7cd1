"""The operators' queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from variantrank.llm import quotes, templates, warc
from variantrank.llm import weak_supervision as ws

SPACES = r"[\x20\x09-\x0D]+"


def _measures(docs: str) -> str:
    """The measures of weak_supervision over a table with doc_id and text."""
    windows = "list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])"
    return f"""
SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{SPACES}', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words, len(l) AS n_lines,
  length(t) - length(replace(t, '!', '')) AS n_exclaims, length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_upper,
  len(regexp_extract_all(t, '[#*$%&|<>]+')) AS n_symbol_runs,
  length(t) - length(regexp_replace(t, '[\\p{{P}}\\p{{S}}]', '', 'g')) AS n_marks
FROM (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM {docs}) d
LEFT JOIN (SELECT row, count(DISTINCT i + k) AS r FROM (
    SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM (
      SELECT row, unnest({windows}) AS g, unnest(range(1, len(w) - 1)) AS i FROM (
        SELECT row_number() OVER () AS row, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> '') AS w FROM {docs}))),
    (VALUES (0), (1), (2)) s(k) WHERE n > 1 GROUP BY row) r USING (row)"""


def quality_sql(docs: str, columns: str) -> str:
    """weak_supervision.quality: one common table per iteration, over the table of vote patterns."""
    rules = ws.RULES
    votes = ", ".join(f"CASE WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END AS v{k}" for k, (_, good, bad) in enumerate(rules))
    names = ", ".join(f"v{k}" for k in range(len(rules)))
    odds = "ln(p / (1 - p)) + " + " + ".join(
        f"CASE v{k} WHEN 1 THEN ln(g{k} / (1 - b{k})) WHEN -1 THEN ln((1 - g{k}) / b{k}) ELSE 0.0::DOUBLE END" for k in range(len(rules))
    )
    start = ", ".join([f"{ws.START.prior}::DOUBLE AS p"] + [f"{ws.START.good[k]}::DOUBLE AS g{k}, {ws.START.bad[k]}::DOUBLE AS b{k}" for k in range(len(rules))])

    def rate(right: str, every: str, least: float, said: float) -> str:
        return (
            f"least({ws.MOST}::DOUBLE, greatest({least}::DOUBLE, (coalesce(sum({right}), 0) + {said}::DOUBLE * {ws.PSEUDO_VOTES}::DOUBLE)"
            f" / (coalesce(sum({every}), 0) + {ws.PSEUDO_VOTES}::DOUBLE)))"
        )

    steps = [f"m0 AS MATERIALIZED (SELECT {start})"]
    for i in range(ws.ITERATIONS):
        learned = ", ".join(
            [f"(sum(g) + {ws.START.prior}::DOUBLE * {ws.PSEUDO_VOTES}::DOUBLE) / (sum(n) + {ws.PSEUDO_VOTES}::DOUBLE) AS p"]
            + [
                f"{rate(f'CASE WHEN v{k}=1 THEN g END', f'CASE WHEN v{k}<>0 THEN g END', ws.LEAST_GOOD, ws.START.good[k])} AS g{k}, "
                f"{rate(f'CASE WHEN v{k}=-1 THEN n-g END', f'CASE WHEN v{k}<>0 THEN n-g END', ws.LEAST_BAD, ws.START.bad[k])} AS b{k}"
                for k in range(len(rules))
            ]
        )
        steps.append(f"m{i + 1} AS MATERIALIZED (SELECT {learned} FROM (SELECT {names}, n, n / (1 + exp(-({odds}))) AS g FROM patterns, m{i}))")
    return f"""WITH measured AS MATERIALIZED ({_measures(docs)}),
voted AS MATERIALIZED (SELECT *, {votes} FROM measured),
patterns AS MATERIALIZED (SELECT {names}, count(*)::DOUBLE AS n FROM voted GROUP BY {names}),
{', '.join(steps)},
judged AS (SELECT *, {ws.BASE_FAILED} AS base_failed, 1 / (1 + exp(-({odds}))) AS quality FROM voted, m{ws.ITERATIONS})
SELECT {columns} FROM judged"""


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACES}'), lambda x: x <> '')"


def _template(text: str, every: bool) -> str:
    """templates.canonical without its marks removed. Two passes stand for the look-behind that RE2 has not."""
    name, number, unit = templates.NAME, templates.NUMBER, templates.UNIT
    if every:
        text = rf"regexp_replace({text}, '(^|[^\p{{L}}])\p{{Lu}}\p{{Ll}}+', '\1{name}', 'g')"
    else:
        for before in (r"[\p{Ll},;]", rf"[\p{{Ll}},;{name}]"):
            text = rf"regexp_replace({text}, '({before} )\p{{Lu}}\p{{Ll}}+', '\1{name}', 'g')"
    text = rf"regexp_replace(lower({text}), '\p{{N}}+([.,:/]\p{{N}}+)*', '{number}', 'g')"
    for _ in range(2):
        text = rf"regexp_replace({text}, '({number} ?)({templates.UNITS})([^\p{{L}}]|$)', '\1{unit}\3', 'g')"
    return text


def leaks_sql() -> str:
    """templates.leaks over documents and benchmark: both kinds of templates, then runs of the same words."""
    text = "coalesce(text, '')"
    bare = lambda x: rf"regexp_replace({x}, '[\p{{P}}\p{{S}}]+', '', 'g')"
    slot = f"('{templates.NAME}', '{templates.NUMBER}', '{templates.UNIT}')"
    plain = lambda x: rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}%€£°]+', '', 'g')"
    side = lambda x: f"len(list_distinct(list_transform(slots, lambda s: s.{x})))"
    words = ", ".join(
        [f"{_words(bare(text))} AS said", f"{_words(bare(f'lower({text})'))} AS plain"]
        + [f"{_words(bare(_template(text, every)))} AS {kind}" for kind, every in templates.KINDS.items()]
    )
    run = f"least(len(plain), {templates.RUN})"
    parts = [f"d AS MATERIALIZED (SELECT doc_id, {words} FROM documents)", f"b AS MATERIALIZED (SELECT item_id, {words} FROM benchmark)"]
    for k in templates.KINDS:
        parts.append(f"""items_{k} AS (SELECT min(item_id) AS item_id, said, {k} AS tem, least(len({k}), {templates.WINDOW}) AS n FROM b
  WHERE len(said) >= {templates.MIN_WORDS} GROUP BY said, {k}),
cut_{k} AS (SELECT item_id, n, s AS item_at, said[s+1:s+n] AS item_said, tem[s+1:s+n] AS win FROM
  (SELECT *, unnest(range(0, len(tem) - n + 1)) AS s FROM items_{k})),
known_{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY item_id) AS item_windows FROM cut_{k}
  WHERE len(list_filter(win, lambda w: w NOT IN {slot} AND w <> '')) >= {templates.MIN_LITERALS}),
wins_{k} AS (SELECT doc_id, s AS pos, n, said[s+1:s+n] AS doc_said, {k}[s+1:s+n] AS win FROM
  (SELECT *, unnest(range(0, len({k}) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM known_{k}) WHERE len({k}) >= n)),
met_{k} AS (SELECT doc_id, item_id, item_windows, pos, item_at, pos - item_at AS shift,
  list_transform(list_filter(range(1, w.n + 1), lambda k: w.win[k] IN {slot}),
    lambda k: {{'asked': {plain('item_said[k]')}, 'found': {plain('doc_said[k]')}}}) AS slots
  FROM wins_{k} w JOIN known_{k} k ON w.n = k.n AND w.win = k.win),
lines_{k} AS (SELECT doc_id, item_id, item_windows, shift, list(DISTINCT item_at) AS starts, min(pos) AS pos,
  list_distinct(flatten(list(slots))) AS slots FROM met_{k} GROUP BY ALL),
good_{k} AS (SELECT *, {side('asked')} AS asked, len(list_filter(slots, lambda s: s.asked <> s.found)) AS changed FROM lines_{k}
  WHERE len(slots) = {side('asked')} AND len(slots) = {side('found')}),
held_{k} AS MATERIALIZED (SELECT doc_id, item_id, len(list_distinct(flatten(list(starts)))) AS n_windows, item_windows, max(asked) AS n_slots,
  max(changed) AS changed_slots, min(pos) AS first_word FROM good_{k} GROUP BY doc_id, item_id, item_windows
  HAVING len(list_distinct(flatten(list(starts)))) >= {templates.LEAK_FROM} * item_windows)""")
    return f"""WITH {(','+chr(10)).join(parts)},
items_run AS (SELECT min(item_id) AS item_id, plain, {run} AS n FROM b WHERE len(plain) >= {templates.MIN_RUN} GROUP BY plain),
cut_run AS (SELECT item_id, len(plain) AS size, n, plain[s+1:s+n] AS win FROM (SELECT *, unnest(range(0, len(plain) - n + 1)) AS s FROM items_run)),
wins_run AS (SELECT doc_id, s AS pos, n, plain[s+1:s+n] AS win FROM
  (SELECT *, unnest(range(0, len(plain) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM cut_run) WHERE len(plain) >= n)),
held_run AS (SELECT doc_id, item_id, 0 AS n_windows, greatest(size - {templates.WINDOW} + 1, 1) AS item_windows, 0 AS n_slots, 0 AS changed_slots,
  min(pos) AS first_word FROM wins_run w JOIN cut_run k ON w.n = k.n AND w.win = k.win GROUP BY doc_id, item_id, size),
first AS MATERIALIZED (SELECT * FROM held_named UNION ALL SELECT h.* FROM held_capital h WHERE NOT EXISTS (SELECT 1 FROM held_named n
  WHERE n.doc_id IS NOT DISTINCT FROM h.doc_id AND n.item_id IS NOT DISTINCT FROM h.item_id))
SELECT * FROM first UNION ALL SELECT h.* FROM held_run h WHERE NOT EXISTS (SELECT 1 FROM first f
  WHERE f.doc_id IS NOT DISTINCT FROM h.doc_id AND f.item_id IS NOT DISTINCT FROM h.item_id)"""


def links_sql() -> str:
    """quotes.link over conversations."""
    marks = r"^([ \t]*>)+"
    words = lambda said: rf"list_filter(regexp_split_to_array(lower({said}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    joined = lambda said: f"array_to_string({words(said)}, ' ')"
    n = quotes.WINDOW
    windows = f"list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i+{n}-1], ' '))"
    short = f"list_filter(list_transform(said, lambda s: {words('s')}), lambda v: len(v) BETWEEN 1 AND {n - 1})"
    return f"""WITH RECURSIVE messages AS (SELECT *, row_number() OVER () AS row FROM conversations),
raw AS (SELECT row, conv_id, turn, unnest(l) AS line, unnest(range(len(l))) AS i FROM
  (SELECT *, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS l FROM messages)),
levels AS (SELECT *, length(regexp_replace(regexp_extract(line, '{marks}'), '[^>]', '', 'g')) AS level,
  regexp_replace(line, '{marks}[ \t]?', '') AS said FROM raw),
lines AS MATERIALIZED (SELECT * FROM (SELECT *, lead(level) OVER (PARTITION BY row ORDER BY i) AS next FROM levels)
  WHERE NOT (level = 0 AND coalesce(next, 0) > 0 AND regexp_matches(said, '{quotes.ATTRIBUTION}'))),
blocks AS MATERIALIZED (SELECT row, conv_id, turn, block, level, said, {words("array_to_string(said, ' ')")} AS w FROM
  (SELECT row, conv_id, turn, block, level, list(said ORDER BY i) AS said FROM
    (SELECT *, sum(new) OVER (PARTITION BY row ORDER BY i) - 1 AS block FROM
      (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY row ORDER BY i) THEN 1 ELSE 0 END AS new FROM lines)) GROUP BY ALL)),
pieces AS (SELECT *, list_distinct({windows} || list_transform({short}, lambda v: array_to_string(v, ' '))
  || CASE WHEN len(w) < {n} THEN [array_to_string(w, ' ')] ELSE [] END) AS pieces, array_to_string(w, ' ') AS all_of_it FROM blocks WHERE level > 0 AND len(w) > 0),
quoted AS MATERIALIZED (SELECT DISTINCT conv_id, turn, block, level, len(pieces) AS total, passage,
    list_contains(pieces, passage) AS piece, passage = all_of_it AS whole FROM
  (SELECT *, unnest(list_distinct(list_append(pieces, all_of_it))) AS passage FROM pieces)),
own_units AS (SELECT conv_id, turn, unnest({windows} || [array_to_string(w, ' ')]) AS passage FROM blocks WHERE level = 0
  UNION ALL SELECT conv_id, turn, {joined("said")} FROM lines WHERE level = 0
  UNION ALL SELECT conv_id, turn, {joined("s")} FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(said, '[.!?]+')) AS s FROM lines WHERE level = 0)
  UNION ALL SELECT conv_id, turn, {joined("s")} FROM (SELECT conv_id, turn, string_agg(said, chr(10) ORDER BY i) AS s FROM lines WHERE level = 0 GROUP BY row, conv_id, turn)),
origins AS (SELECT conv_id, passage, min(turn) AS origin FROM own_units WHERE passage <> '' GROUP BY ALL),
held AS (SELECT conv_id, turn, block, level, total, origin, count(*) FILTER (piece) AS n, bool_or(whole) AS whole
  FROM quoted JOIN origins USING (conv_id, passage) WHERE origin < turn GROUP BY ALL),
strength AS (SELECT conv_id, turn, origin, min(level) AS level, bool_or(whole) AS whole, sum(n) AS n FROM held
  WHERE whole OR 2 * n >= total OR n >= {quotes.LEAST} GROUP BY ALL),
links AS MATERIALIZED (SELECT conv_id, turn, origin AS parent FROM
  (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, whole DESC, n DESC, origin DESC) AS rank FROM strength) WHERE rank = 1),
climb AS (SELECT conv_id, turn, parent AS root FROM links UNION ALL
  SELECT c.conv_id, c.turn, l.parent FROM climb c JOIN links l ON c.conv_id = l.conv_id AND c.root = l.turn),
roots AS (SELECT conv_id, turn, min(root) AS root FROM climb GROUP BY ALL),
own AS (SELECT row, coalesce(string_agg(said, chr(10) ORDER BY i) FILTER (level = 0), '') AS own, max(level) AS quote_depth FROM lines GROUP BY row),
done AS (SELECT conv_id, turn, role, CASE WHEN text IS NULL THEN NULL WHEN quote_depth > 0 THEN trim(own, ' ' || chr(9) || chr(10)) ELSE text END AS text,
  quote_depth, parent, coalesce(root, turn) AS thread FROM messages JOIN own USING (row) LEFT JOIN links USING (conv_id, turn) LEFT JOIN roots USING (conv_id, turn))
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS position FROM done"""


def repair_sql() -> str:
    """structure_repair over damaged conversations: one step of the recursion takes every conversation one row further."""
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    bits = "list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b))"
    codes = f"list_transform(string_split({key}, ''), lambda x: ascii(x)::BIGINT)"
    check = f"xor(list_reduce({codes}, lambda c, b: {bits}, 4294967295::BIGINT), 4294967295::BIGINT)"
    never, n = 1 << 40, "chr(10)"

    def way(state: str, cost: str, edits: str, said: str = "") -> str:
        more = "".join(f" || {n} || {x}" for x in said.split("+") if x)
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}', 'r': {state}.r{more}}}"

    def least(ways: list[str]) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def to(state: str, initial: str, role: str, other: str, before: str) -> str:
        out = [way(state, "3", "D")]
        for s in "nsua":
            gap, insert = ("", "") if s in before else ("I", f"'{other}:'+")
            cost = f"cut + {0 if s in before else 2}"
            out.append(way(s, f"{cost} + 2", gap + "R", f"{insert}'{role}:' || text"))
            out.append(way(s, f"{cost} + CASE WHEN role[1:1] = '{initial}' THEN 0 ELSE {never} END", gap + "K", f"{insert}role || ':' || text"))
        return f"CASE WHEN forced THEN {way(state, '3', 'D')} ELSE {least(out)} END"

    system = least([way("s", "3", "D"), way("n", f"cut + CASE WHEN role[1:1] = 's' THEN 0 ELSE {never} END", "K", "role || ':' || text")])
    zero, no = "{'c': 0::BIGINT, 'a': '', 'r': ''}", f"{{'c': {never}::BIGINT, 'a': '', 'r': ''}}"
    end = least(["n", way("s", "4", "II", "'user:'+'assistant:'"), way("u", "2", "I", "'assistant:'"), "a"])
    return f"""WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {check} % 20 AS f FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM keyed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n FROM damaged),
told AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS unended,
  lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1:1] AS pair FROM placed),
lined AS MATERIALIZED (SELECT *, blank OR again AS forced, unended::INT AS cut FROM told),
walked(conv_id, i, n, s, u, a) AS (SELECT conv_id, 0::BIGINT, {zero}, {no}, {no}, {no} FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT w.conv_id, i + 1, {way('w.n', '3', 'D')}, CASE WHEN forced THEN {way('s', '3', 'D')} ELSE {system} END,
  {to('u', 'u', 'user', 'assistant', 'nsa')}, {to('a', 'a', 'assistant', 'user', 'u')}
  FROM (SELECT conv_id, i, n, s, u, a FROM walked) w JOIN (SELECT conv_id, n AS at, role, text, forced, cut FROM lined) l
  ON w.conv_id IS NOT DISTINCT FROM l.conv_id AND l.at = w.i + 1),
done AS (SELECT conv_id, {end} AS best FROM (SELECT * FROM walked QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (unended AND NOT blank AND NOT again) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM lined GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM done d LEFT JOIN counts c ON d.conv_id IS NOT DISTINCT FROM c.conv_id"""


def archive_sql() -> str:
    """What warc.read returns of archives of all pages."""
    return f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
best AS (SELECT html, count(*) AS n, max(page_id) AS largest FROM p WHERE octet_length(encode(html)) >= {warc.LEAST_REVISIT} GROUP BY html),
named AS (SELECT p.*, b.n, b.largest, p.page_id IS NOT DISTINCT FROM b.largest AND p.url IS NOT DISTINCT FROM max(p.url) FILTER (p.page_id IS NOT DISTINCT FROM b.largest)
  OVER (PARTITION BY p.html) AS is_best FROM p LEFT JOIN best b USING (html))
SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n > 1 AND NOT is_best THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n > 1 AND NOT is_best THEN largest END AS refers_to FROM named"""


ORACLE = {
    "op12_warc_segments": archive_sql(),
    "op13_structure_repair": repair_sql(),
    "op2_quotation_links": links_sql(),
    "op5_template_leaks": leaks_sql(),
    "op6_quality_votes": quality_sql(
        "documents",
        "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        f"NOT base_failed AND quality >= {ws.KEEP_FROM} AS kept",
    ),
}
