"""DuckDB statements of the operators whose exact result SQL can say.

They compare all windows, shingles or spans directly; fine on small tables.
"""

from __future__ import annotations

from strata.llm import secrets as S

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str, pattern: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}'), "
            f"'{pattern}')")


_SPACE = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def near_duplicates(n: int = 3, percent: int = 85) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text', _SPACE)} AS w
  FROM documents),
sh AS (SELECT DISTINCT rid, array_to_string(w[i:i + {n - 1}], ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS i FROM d WHERE len(w) > 0) x),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
pair AS (SELECT a.rid AS x, b.rid AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid
  GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN n a ON a.rid = x JOIN n b ON b.rid = y
  WHERE 100 * k >= {percent} * (a.n + b.n - k)),
e AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(rid, r) AS (SELECT rid, rid FROM d UNION SELECT reach.rid, e.y FROM reach JOIN e ON e.x = reach.r),
comp AS (SELECT reach.rid, min(d.doc_id) AS component_id FROM reach JOIN d ON d.rid = reach.r GROUP BY reach.rid)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN comp USING (rid) LEFT JOIN n USING (rid)"""


def repeats(n: int = 50) -> str:
    return f"""
WITH d AS (SELECT doc_id, {_words('text', _SPACE)} AS w FROM documents),
win AS (SELECT doc_id, i - 1 AS s, md5(array_to_string(w[i:i + {n - 1}], ' ')) AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n}) x),
shared AS (SELECT p FROM win GROUP BY p HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) > 1),
st AS (SELECT DISTINCT doc_id, s FROM win JOIN shared USING (p)),
cut AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER w + {n} THEN 0 ELSE 1 END AS new
  FROM st WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
span AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM cut)
SELECT doc_id, min(s) AS "start", max(s) + {n} AS "end", max(s) + {n} - min(s) AS n_words
FROM span GROUP BY doc_id, k"""


def decontaminate(n: int = 10) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text', _ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {_words('text', _ALNUM)} AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT item_id, w, least({n}, len(w)) AS m, unnest(range(1, len(w) - least({n}, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0) x),
win AS (SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d JOIN (SELECT DISTINCT m FROM pat) l ON len(w) >= m) x),
hit AS (SELECT rid, m, i, item_id FROM win JOIN pat USING (m, p)),
words AS (SELECT rid, count(DISTINCT k) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + m)) AS k FROM hit) x GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS h
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) x GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def _kind(name: str, pattern: str, ok: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
SELECT rid, {S.KINDS[name][0]} AS k, s, s + length(x) AS e FROM (
  SELECT rid, m[i] AS x, list_sum(list_transform(g[1:i], lambda v: length(v)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS s
  FROM (SELECT rid, g, m, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT rid, string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}') AS m FROM d
    WHERE regexp_matches(t, '{p}')) y) z) v WHERE {ok.replace('PATTERN', p)}"""


def secrets() -> str:
    ok = {"assign": f"length(regexp_extract(x, 'PATTERN', 2)) >= {S.ASSIGN_MIN}",
          "random": " AND ".join(f"regexp_matches(x, '{c}')" for c in S.RANDOM_HAS)}
    found = " UNION ALL ".join(_kind(n, p, ok.get(n, "true")) for n, (p, _) in S.PATTERNS.items())
    role = " ".join(f"WHEN {k} THEN '{r}'" for k, r in S.KINDS.values())
    name = " ".join(f"WHEN {k} THEN '{n}'" for n, (k, _) in S.KINDS.items())
    needs = " OR ".join(f"(w.k = {S.KINDS[n][0]} AND o.role IN ({', '.join(repr(r) for r in rs)}))"
                        for n, rs in S.NEEDS.items())
    weak = ", ".join(str(S.KINDS[n][0]) for n in S.NEEDS)
    text = f"string_agg(CASE k {name} END || ':' || s || ':' || e, ',' ORDER BY s, k)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({found}),
r AS (SELECT *, CASE k {role} END AS role FROM f),
held AS (SELECT DISTINCT w.rid, w.k, w.s, w.e FROM r w JOIN r o
  ON w.rid = o.rid AND abs(w.s - o.s) <= {S.SCOPE} AND ({needs}) WHERE w.k IN ({weak})),
base AS (SELECT rid, count_if(k = 0) AS n0, count_if(k = 1) AS n1, count_if(k = 2) AS n2, {text} AS b
  FROM f WHERE k < 3 GROUP BY rid),
every AS (SELECT rid, {text} AS a, count_if(k >= 3) AS n_linked
  FROM (SELECT rid, k, s, e FROM f WHERE k < 3 UNION ALL SELECT * FROM held) u GROUP BY rid)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access,
  coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans,
  coalesce(n_linked, 0)::BIGINT AS n_linked
FROM d LEFT JOIN base USING (rid) LEFT JOIN every USING (rid)"""
