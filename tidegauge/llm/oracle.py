"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from tidegauge.llm.queries import EPOCHS, LEVELS, SEED, SHARE, WEIGHTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT = r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare,
         length(coalesce(text, '')) AS points
  FROM documents
), grouped AS (
  SELECT doc_id, bare, first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM grouped
"""

WARC = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), tops AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top
  FROM sized
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM tops
"""

CONTAMINATION = rf"""
WITH lists AS (
  SELECT 'd' AS kind, doc_id AS id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
  UNION ALL
  SELECT 'i', item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(words[p : p + n - 1], ' ') AS gram
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM (SELECT *, least(len(words), 10) AS n FROM lists WHERE kind = 'i' AND len(words) > 0))
), doc_windows AS (
  SELECT id AS doc_id, n, p, array_to_string(words[p : p + n - 1], ' ') AS gram
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM lists, (SELECT DISTINCT n FROM item_windows) WHERE kind = 'd')
), found AS (
  SELECT doc_id, p, d.n, item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.gram = i.gram
), hits AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM found))
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS item_id FROM found) GROUP BY doc_id
)
SELECT l.id AS doc_id, len(words)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM lists l LEFT JOIN hits h ON l.id = h.doc_id LEFT JOIN items t ON l.id = t.doc_id
WHERE kind = 'd'
"""


def _weight(level: str) -> str:
    cases = "".join(f" WHEN '{name}' THEN {w}" for name, w in WEIGHTS.get(level, {}).items())
    return f"CASE {level}{cases} ELSE 1 END" if cases else "1"


def _mixing() -> str:
    every = ", ".join(LEVELS)
    parts = [
        rf"""
WITH named AS (
  SELECT *, 'd' || (ascii(md5(coalesce(source, ''))) % 4) AS domain FROM documents
), rows AS (
  SELECT coalesce(doc_id::varchar, '') AS id, doc_id, {", ".join(f"coalesce({c}, '(none)') AS {c}" for c in LEVELS)},
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::bigint AS n_tokens
  FROM named
), leaves AS (
  SELECT {every}, sum(n_tokens)::bigint AS supply FROM rows GROUP BY ALL
), given0 AS (
  SELECT floor(sum(supply) * {SHARE}::double)::bigint AS given FROM leaves
)"""
    ]
    for depth, level in enumerate(LEVELS, 1):
        path = ", ".join(LEVELS[:depth])
        parents = ", ".join(LEVELS[: depth - 1])
        by = f"PARTITION BY {parents} " if parents else ""
        using = f"JOIN given{depth - 1} USING ({parents})" if parents else f"CROSS JOIN given{depth - 1}"
        parts.append(
            f""", nodes{depth} AS (
  SELECT {path}, most::hugeint AS most, weight::hugeint AS weight, given::hugeint AS given
  FROM (SELECT {path}, sum(supply * {EPOCHS}) AS most, {_weight(level)} AS weight FROM leaves GROUP BY {path}) {using}
  WHERE most > 0 AND weight > 0
), marked{depth} AS (
  SELECT *, most * after <= (given - before) * weight AS filled
  FROM (SELECT *,
          coalesce(sum(most) OVER ({by}ORDER BY most / weight, {level}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::hugeint AS before,
          (sum(weight) OVER ({by}ORDER BY most / weight, {level}
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::hugeint AS after
        FROM nodes{depth})
), given{depth} AS (
  SELECT {path}, CASE WHEN filled THEN most ELSE rest * weight // open END::bigint AS given
  FROM (SELECT *,
          (given - coalesce(sum(CASE WHEN filled THEN most END) OVER ({by}), 0))::hugeint AS rest,
          (sum(CASE WHEN NOT filled THEN weight END) OVER ({by}))::hugeint AS open
        FROM marked{depth})
)"""
        )
    parts.append(
        f""", dealt AS (
  SELECT {every}, supply, given // supply AS whole, given - given // supply * supply AS room
  FROM leaves JOIN given{len(LEVELS)} USING ({every}) WHERE given > 0
), keyed AS (
  SELECT *, md5(concat_ws(':', id, '{SEED}', whole)) AS key FROM rows JOIN dealt USING ({every})
), run AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY {every} ORDER BY key, id) AS upto FROM keyed
)
SELECT doc_id, {every}, n_tokens, (whole + (upto <= room)::bigint)::bigint AS epochs
FROM run WHERE whole + (upto <= room)::bigint > 0
"""
    )
    return "".join(parts)


NEAR = rf"""
WITH RECURSIVE lists AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'),
                             lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p : p + 2], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS p FROM lists WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON r.node = e.a WHERE r.root < e.b
), smallest AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::bigint AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN smallest ON doc_id = node LEFT JOIN sizes USING (doc_id)
"""

# the CRC-32 of a decimal id, bit by bit
CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda d: ascii(d)::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
         ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), built AS (
  SELECT t.c, list_concat(coalesce(b.own, [])[1 : h], t.own[h + 1 :]) AS path
  FROM (SELECT *, ({CRC} % 6)::bigint AS h FROM turns) t LEFT JOIN turns b ON b.c = t.c - t.c % 100
), prefixes AS (
  SELECT c, d, path[1 : d] AS prefix, len(path) = d AS last FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM built)
), nodes AS (
  SELECT d, prefix, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (last), '') AS ends,
         CASE WHEN d > 0 THEN length(prefix[d].text) ELSE 0 END AS points
  FROM prefixes GROUP BY d, prefix
), kids AS (
  SELECT p.d, p.prefix, count(k.d) AS n_children, min(up.conv_id) AS parent_conv_id
  FROM nodes p LEFT JOIN nodes k ON k.d = p.d + 1 AND k.prefix[1 : p.d] = p.prefix
  LEFT JOIN nodes up ON up.d = p.d - 1 AND up.prefix = p.prefix[1 : p.d - 1]
  GROUP BY p.d, p.prefix
)
SELECT n.conv_id, n.d AS depth, k.parent_conv_id, n.n_convs, k.n_children,
       sum((s.n_children = 0)::bigint)::bigint AS n_leaves, sum((m.n_convs - 1) * m.points)::bigint AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN kids k ON k.d = n.d AND k.prefix = n.prefix
JOIN nodes m ON m.d >= n.d AND m.prefix[1 : n.d] = n.prefix JOIN kids s ON s.d = m.d AND s.prefix = m.prefix
GROUP BY ALL
"""

ORACLE = {
    "op1_exact_dedup": EXACT,
    "op2_warc": WARC,
    "op3_decontamination": CONTAMINATION,
    "op4_mixing": _mixing(),
    "op5_near_dedup": NEAR,
    "op12_conversation_trie": TRIE,
}
