"""DuckDB twins of those text queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# CRC-32 by its definition, a bit at a time over the bytes of the text.
_CRC = """list_reduce(
    [4294967295::BIGINT] || list_transform(range(octet_length(encode({x}))),
        lambda i: CAST(('0x' || substr(hex(encode({x})), 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))"""


def crc32_of(x: str) -> str:
    """SQL for the unsigned CRC-32 of a text expression."""
    return f"xor({_CRC.format(x=x)}, 4294967295)"


def _url_filter() -> str:
    orders = []
    for k in range(4):
        before = f"left(right(gram, {k + 1}), {k})"
        sides = {}
        for side in ("good", "bad"):
            total = f"coalesce(t.{side}, 0)" if k else f"(SELECT coalesce(sum({side}), 0) FROM counted)"
            sides[side] = (
                f"CASE WHEN length(p.gram) > {k} THEN (coalesce(h.{side}, 0) + 2.0 * p.p_{side})"
                f" / ({total} + 2.0) ELSE p.p_{side} END AS p_{side}"
            )
        around = (
            f"LEFT JOIN (SELECT {before} AS before, sum(good) AS good, sum(bad) AS bad FROM counted"
            f" WHERE length(gram) > {k} GROUP BY 1) t ON t.before = left(right(p.gram, {k + 1}), {k})"
            if k
            else ""
        )
        orders.append(
            f"p{k} AS (SELECT p.gram, {sides['good']}, {sides['bad']} FROM p{k - 1 if k else 'x'} p LEFT JOIN"
            f" (SELECT right(gram, {k + 1}) AS own, sum(good) AS good, sum(bad) AS bad FROM counted"
            f" WHERE length(gram) > {k} GROUP BY 1) h ON h.own = right(p.gram, {k + 1}) {around})"
        )
    return f"""
WITH parsed AS (
  SELECT page_id, coalesce(url, '') AS shape,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parsed),
judged AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END
    AS decided FROM ruled),
shapes AS (
  SELECT shape, decided, n, {crc32_of('shape')} % 5 = 0 AS out
  FROM (SELECT shape, decided, count(*) AS n FROM judged GROUP BY shape, decided)),
grams AS (
  SELECT shape, decided, n, out, substr('^' || shape || '$', greatest(1, i - 3)::INT, least(i, 4)::INT) AS gram
  FROM (SELECT *, unnest(range(2, length(shape) + 3)) AS i FROM shapes)),
counted AS (
  SELECT gram, coalesce(sum(n * (decided = 'allow' AND NOT out)::INT), 0) AS good,
    coalesce(sum(n * (decided = 'block' AND NOT out)::INT), 0) AS bad
  FROM grams GROUP BY gram),
px AS (SELECT gram, 1.0::DOUBLE / 128 AS p_good, 1.0::DOUBLE / 128 AS p_bad FROM counted),
{', '.join(orders)},
scored AS (
  SELECT shape, decided, any_value(out) AS out, any_value(n) AS n, avg(ln(p_good) - ln(p_bad)) AS score
  FROM grams JOIN p3 USING (gram) GROUP BY shape, decided),
steps AS (
  SELECT least(greatest(round(score * 100), -1000), 1000)::BIGINT AS step,
    sum(n * (decided = 'allow')::INT) AS good, sum(n * (decided = 'block')::INT) AS bad
  FROM scored WHERE decided IS NOT NULL AND out GROUP BY 1),
sums AS (
  SELECT step, sum(good) OVER () AS all_good, sum(bad) OVER () AS all_bad,
    sum(good) OVER (ORDER BY step) AS lost, sum(bad) OVER (ORDER BY step) AS spared FROM steps),
gains AS (
  SELECT step + 1 AS cut, round(spared / all_bad + 1 - lost / all_good, 9) AS gain FROM sums
  WHERE all_good > 0 AND all_bad > 0
  UNION ALL SELECT min(step), 1.0 FROM sums HAVING min(all_good) > 0 AND min(all_bad) > 0),
chosen AS (SELECT coalesce((SELECT (cut - 0.5) / 100 FROM gains ORDER BY gain DESC, cut LIMIT 1), 0.0) AS cut)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.decided, CASE WHEN s.score >= (SELECT cut FROM chosen) THEN 'allow' ELSE 'block' END) AS verdict
FROM judged j LEFT JOIN scored s ON s.shape = j.shape AND s.decided IS NULL AND j.decided IS NULL
"""


ORACLES["op3_url_filter"] = _url_filter()


def _quality_rules() -> str:
    from tallyloom.llm.quality_rules import LEVEL, RATE, RULES, STRATA

    rate = RATE / len(RULES)
    level = LEVEL / (len(STRATA) * sum(map(len, RULES.values())))
    stratum = " ".join(f"WHEN n_words >= {low} THEN {k}" for k, low in reversed(list(enumerate(STRATA))))
    cells = " UNION ALL ".join(
        f"SELECT stratum, '{rule}' AS rule, {c} AS cutoff, count(*) AS n, sum(({rule} > {c})::INT) AS rejected"
        f" FROM holdout GROUP BY stratum"
        for rule, cutoffs in RULES.items()
        for c in cutoffs
    )
    rejects = " OR ".join(f"(c.rule = '{rule}' AND m.{rule} > c.cutoff)" for rule in RULES)
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \\t-\\r]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS times
  FROM (SELECT doc_id, i, words[i:i + 4] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM docs))),
repeats AS (
  SELECT doc_id, sum(covers) AS n FROM (
    SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS covers
    FROM windows WHERE times > 1) GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN repeats r USING (doc_id)),
measured AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE {stratum} END AS stratum,
    CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats,
    CASE WHEN n_words > 0 THEN word_chars * 10 // n_words ELSE 0 END AS word_length,
    CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capitals
  FROM counts),
good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND {crc32_of('doc_id::VARCHAR')} % 5 <> 0
  GROUP BY doc_id HAVING min(quality) = 1),
holdout AS (SELECT * FROM measured WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
tests AS ({cells}),
cutoffs AS (
  SELECT stratum, rule, min(cutoff) AS cutoff FROM tests
  WHERE rejected < n * {rate} AND list_sum(list_transform(range(0, rejected::BIGINT + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))) <= {level}
  GROUP BY stratum, rule)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM cutoffs c WHERE c.stratum = m.stratum AND ({rejects})) AS kept
FROM measured m
"""


ORACLES["op9_quality_rules"] = _quality_rules()


def _substring_dedup() -> str:
    return """
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (w) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


def _decontamination() -> str:
    split = (
        "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        " 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    )
    return f"""
WITH docs AS (SELECT doc_id, {split} AS ws FROM documents),
items AS (SELECT item_id, {split} AS ws FROM benchmark),
sought AS (
  SELECT DISTINCT item_id, n, md5(array_to_string(ws[i:i + n - 1], ' ')) AS w
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM (SELECT item_id, ws, least(10, len(ws)) AS n FROM items WHERE len(ws) > 0))),
sizes AS (SELECT DISTINCT n FROM sought),
windows AS (
  SELECT doc_id, n, i, md5(array_to_string(ws[i:i + n - 1], ' ')) AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n)),
found AS (SELECT doc_id, item_id, n, i FROM windows JOIN sought USING (n, w)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  sha256(coalesce(m.list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN names m USING (doc_id)
"""


ORACLES["op6_substring_dedup"] = _substring_dedup()
ORACLES["op7_decontamination"] = _decontamination()
