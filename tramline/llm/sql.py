"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from .mixing import DEFAULT, EPOCHS, FRACTION, OTHER_DOMAIN, SEED
from .substring_dedup import WIDTH
from .url_filter import LISTED
from .vector_dedup import COSINE

BLANK = "' ' || chr(9) || chr(10) || chr(13)"
TOKENS = f"string_split_regex(trim(text, {BLANK}), '[ \\t\\n\\r]+')"


def case(column: str, values: dict, other) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items()) + f" ELSE {other!r} END"


URL_FILTER = rf"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://', ''), '[?#].*$', '') AS r FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(r, '^[^/@]*@', ''), '/+$', '') AS r FROM a),
c AS (SELECT page_id, url, r, regexp_replace(regexp_replace(string_split(r, '/')[1], ':[0-9]*$', ''), '\.+$', '') AS h FROM b),
d AS (SELECT page_id, url, r, string_split(h, '.') AS l FROM c),
e AS (SELECT page_id, url, list_append(list_transform(range(1, greatest(1, len(l) - 1) + 1), lambda i: array_to_string(l[i:], '.')), r) AS k FROM d)
SELECT page_id, url, list_has_any(k, [{", ".join(f"'{x}'" for x in LISTED)}]) AS listed FROM e
"""

SUBSTRING = f"""
WITH t AS (SELECT doc_id, {TOKENS} AS w FROM documents WHERE trim(text, {BLANK}) <> ''),
p AS (SELECT doc_id, w, unnest(range(0, len(w) - {WIDTH} + 1)) AS i FROM t),
h AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + {WIDTH}], ' ')) AS h FROM p),
f AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM h) WHERE n > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {WIDTH} THEN 0 ELSE 1 END AS new FROM f),
s AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT doc_id, min(i) AS start_token, max(i) + {WIDTH} AS end_token FROM s WHERE doc_id IS NOT NULL GROUP BY doc_id, run
"""

EXACT = """
WITH d AS (SELECT doc_id, md5(text) AS h, doc_id IN (SELECT doc_id FROM labels) AS known FROM documents)
SELECT coalesce(min(doc_id) FILTER (known), min(doc_id)) AS doc_id FROM d GROUP BY h
"""

_domain = "CASE " + " ".join(f"WHEN source IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in DEFAULT.domains.items()) + f" ELSE '{OTHER_DOMAIN}' END"


def _fill(name: str, rows: str, parent: str, keys: str) -> str:
    """A level of the tree: rows has (keys, parent, b, w, c); gives s."""
    return f"""
{name}1 AS (SELECT *, c / w AS need, coalesce(sum(c) OVER (PARTITION BY {parent} ORDER BY c / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS taken,
  sum(w) OVER (PARTITION BY {parent} ORDER BY c / w, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS later FROM {rows}),
{name}2 AS (SELECT *, (b - taken) / later AS level FROM {name}1),
{name}3 AS (SELECT *, first_value(CASE WHEN level < need THEN level END IGNORE NULLS) OVER (PARTITION BY {parent} ORDER BY need, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS cut FROM {name}2),
{name} AS (SELECT *, CASE WHEN cut IS NULL THEN c ELSE least(c, cut * w) END AS s FROM {name}3)"""


MIXING = f"""
WITH base AS (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang, len({TOKENS}) AS n FROM documents WHERE trim(text, {BLANK}) <> ''),
rows_ AS (SELECT *, {_domain} AS domain FROM base),
leaf AS (SELECT domain, lang, source, sum(n)::BIGINT AS n FROM rows_ GROUP BY ALL),
l0 AS (SELECT domain, sum(n::DOUBLE * {EPOCHS}) AS c, (SELECT sum(n) FROM leaf)::DOUBLE * {FRACTION} AS b, ({case("domain", DEFAULT.domain_weights, DEFAULT.domain_other)})::DOUBLE AS w, 0 AS root FROM leaf GROUP BY domain),
{_fill("d", "l0", "root", "domain")},
l1 AS (SELECT domain, lang, sum(n::DOUBLE * {EPOCHS}) AS c, any_value(d.s) AS b, any_value(({case("lang", DEFAULT.lang_weights, DEFAULT.lang_other)})::DOUBLE) AS w FROM leaf JOIN d USING (domain) GROUP BY domain, lang),
{_fill("e", "l1", "domain", "lang")},
l2 AS (SELECT domain, lang, source, n, n::DOUBLE * {EPOCHS} AS c, e.s AS b, 1.0::DOUBLE AS w FROM leaf JOIN e USING (domain, lang)),
{_fill("f", "l2", "domain, lang", "source")},
q AS (SELECT domain, lang, source, n AS total, floor(s + 1e-6)::BIGINT AS quota FROM f),
r AS (SELECT rows_.*, quota // total AS whole, quota % total AS rest, md5('{SEED}:' || (quota // total) || ':' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM rows_ JOIN q USING (domain, lang, source)),
t AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) AS upto FROM r)
SELECT doc_id, domain, lang, source, unnest(range(0, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch FROM t
"""

VECTOR = f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))) AS n FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.n > 0 AND b.n > 0 AND list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {COSINE} * a.n * b.n),
reach AS (SELECT a, b FROM p UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a),
g AS (SELECT a AS vec_id, min(b) AS root FROM reach GROUP BY a)
SELECT root AS vec_id, count(*) AS group_size FROM g GROUP BY root
"""

ORACLES = {
    "op2_url_filter": URL_FILTER,
    "op3_substring_dedup": SUBSTRING,
    "op8_source_mixing": MIXING,
    "op9_exact_dedup": EXACT,
    "op10_vector_dedup": VECTOR,
}
