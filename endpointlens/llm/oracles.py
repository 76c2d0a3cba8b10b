"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = rf"""WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS k FROM texts),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT q.*, first IS NOT NULL AND first <> doc_id AS gone FROM keyed q LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY doc_id"""


def _shrunk(name: str, level: str, parent: str, low: float = 2.0, high: float = 200.0, z: float = 1.645) -> str:
    """CTEs that shrink a level (n, b, prior mean p, weight w of it) with one strength per parent."""
    return f"""{name}0 AS (SELECT {parent}, max(p) AS mean, sum(CASE WHEN n > 1 THEN n END) AS s, sum(CASE WHEN n > 1 THEN n * (b / n - p) * (b / n - p) END) AS spread, sum(CASE WHEN n > 1 THEN p * (1 - p) END) AS noise FROM {level} GROUP BY {parent}),
{name}1 AS (SELECT {parent}, least(greatest(coalesce(CASE WHEN greatest(spread / s - noise / s, 0) > 0 THEN mean * (1 - mean) / greatest(spread / s - noise / s, 0) - 1 END, {high}), {low}), {high}) AS m FROM {name}0),
{name}2 AS (SELECT l.*, least(m, w) AS m FROM {level} l JOIN {name}1 USING ({parent})),
{name}3 AS (SELECT * EXCLUDE (p, w, m), n + m AS weight, (b + m * p) / (n + m) AS mean FROM {name}2),
{name} AS (SELECT *, greatest(mean - {z} * sqrt(mean * (1 - mean) / (weight + 1)), 0) AS lower FROM {name}3)"""


def _levels(host: str) -> str:
    bare = rf"regexp_replace({host}, '(?s)^.*@|\.?:[0-9]*\z|\.\z', '', 'g')"
    labels = f"string_split({bare}, '.')"
    return rf"""{labels} AS ls, CASE WHEN regexp_full_match({bare}, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') THEN 4
  WHEN len({labels}) >= 3 AND {labels}[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') AND length({labels}[-1]) = 2 THEN 2 ELSE 1 END AS keep"""


def _named(source: str, name: str) -> str:
    return f"""{name}0 AS (SELECT *, {_levels("host")} FROM {source}),
{name} AS (SELECT * EXCLUDE (ls, keep), array_to_string(ls[greatest(len(ls) - keep + 1, 1):], '.') AS suffix, array_to_string(ls[greatest(len(ls) - keep, 1):], '.') AS domain FROM {name}0)"""


URL_FILTER = f"""WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules AS (SELECT verdict, text, split_part(text, '/', 1) AS h, substr(text, strpos(text, '/')) AS p
  FROM (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')) t(verdict, text)),
fits AS (SELECT page_id, verdict, text FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(text) DESC, text) = 1),
outcomes AS (SELECT host, CAST(1 - quality AS DOUBLE) AS bad FROM parts JOIN labels ON labels.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})/?\\z', 1) AS BIGINT) WHERE quality IS NOT NULL),
counted AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, sum(bad) AS b FROM outcomes GROUP BY host),
{_named("counted", "hosts")},
domains AS (SELECT suffix, domain, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY suffix, domain),
suffixes AS (SELECT suffix, 1 AS one, sum(n) AS n, sum(b) AS b FROM domains GROUP BY suffix),
overall AS (SELECT (coalesce(sum(b), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS p, coalesce(sum(n), 0) + 1 AS w FROM suffixes),
s AS (SELECT suffixes.*, p, w FROM suffixes, overall), {_shrunk("sp", "s", "one")},
d AS (SELECT domains.*, sp.mean AS p, sp.weight AS w FROM domains JOIN sp USING (suffix)), {_shrunk("dp", "d", "suffix")},
h AS (SELECT hosts.*, dp.mean AS p, dp.weight AS w FROM hosts JOIN dp USING (domain)), {_shrunk("hp", "h", "domain")},
{_named("parts", "placed")}
SELECT q.page_id, q.host, q.path, f.text AS rule, coalesce(f.verdict, CASE WHEN coalesce(hp.lower, dp.lower, sp.lower, 0) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM placed q LEFT JOIN fits f USING (page_id) LEFT JOIN hp ON hp.host = q.host LEFT JOIN dp ON dp.domain = q.domain LEFT JOIN sp ON sp.suffix = q.suffix"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """A CTE pair for each round: a<k> assigns all parts to the codebook c<k-1>, c<k> replaces its entries."""
    away = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.x, c.x)])"
    assigned = lambda k: f"a{k} AS (SELECT row, pos, min({{'d': {away}, 'k': c.k}}) AS best FROM cut p JOIN c{k - 1} c USING (pos) GROUP BY row, pos)"
    floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    replaced = lambda k: f"""s{k} AS (SELECT pos, k, j, sum(v) AS s, count(*) AS n FROM (SELECT pos, best.k AS k, unnest(x) AS v, unnest(range(len(x))) AS j FROM a{k} JOIN cut USING (row, pos)) GROUP BY pos, k, j),
m{k} AS (SELECT pos, k, list({floor} ORDER BY j) AS x FROM s{k} GROUP BY pos, k),
c{k} AS (SELECT pos, k, coalesce(m{k}.x, c.x) AS x FROM c{k - 1} c LEFT JOIN m{k} USING (pos, k))"""  # noqa: E731
    steps = ",\n".join(f"{assigned(k)},\n{replaced(k)}" for k in range(1, rounds + 1))
    return f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
positions AS (SELECT unnest(range({parts})) AS pos),
cut AS (SELECT row, pos, v[pos * (len(v) // {parts}) + 1 : (pos + 1) * (len(v) // {parts})] AS x FROM kept, positions),
c0 AS (SELECT pos, row - 1 AS k, x FROM cut WHERE row <= {entries}),
{steps},
{assigned(rounds + 1)},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', best.k), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds + 1} JOIN kept USING (row) GROUP BY row, vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY pos, k)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"""


VECTOR_CODES = _vector_codes()
