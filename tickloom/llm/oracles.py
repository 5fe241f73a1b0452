"""SQL for the queries that SQL can express over whole tables.

The others need byte pair merges, training, automata or checksums, which SQL lacks or which take too long in it; the tests
hold those queries against brute-force versions.
"""

from __future__ import annotations

from tickloom.llm import url_templates as ut


def _fits(rule: ut.UrlRule) -> str:
    return f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"


def _pick(value: str) -> str:
    ordered = sorted(ut.RULES, key=lambda r: (-len(r.text), r.text))
    return "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{getattr(r, value)}'" for r in ordered) + " END"


def _url_templates() -> str:
    """The tree is walked down by recursion, one segment of every path at a time."""
    shape = "regexp_replace({}, '\\p{{L}}+', 'a', 'g')"
    return f"""
WITH RECURSIVE rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{ut.UPPER}', '{ut.LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
judged AS (
  SELECT *, {_pick("text")} AS rule, {_pick("verdict")} AS ruled,
    [regexp_replace(s, '[0-9]+', '*', 'g') FOR s IN string_split(path, '/') IF s <> ''] AS raw FROM split),
leaves AS (
  SELECT host, raw, count(*)::DOUBLE AS n, count(*) FILTER (ruled = 'block') AS bad, count(ruled) AS known FROM judged GROUP BY ALL),
overall AS (SELECT coalesce(sum(bad) / nullif(sum(known), 0), 0) AS share, max(len(raw)) AS depth FROM leaves),
tree AS (
  SELECT 0 AS level, host, raw, n, '' AS t FROM leaves
  UNION ALL
  SELECT level + 1, host, raw, n, CASE WHEN new = '' THEN t ELSE t || '/' || new END FROM (
    SELECT *, CASE WHEN own <> '' AND (siblings >= {ut.MANY} AND own_n < {ut.RARE} * all_n
        OR siblings > 1 AND 1 + sum(CASE WHEN first THEN abs(cell_n / own_n - shape_n / all_n) - shape_n / all_n ELSE 0 END)
          OVER (PARTITION BY host, t, own) <= {ut.SIMILAR} + 1 / sqrt(own_n)) THEN '*' ELSE own END AS new
    FROM (
      SELECT *, sum(n) OVER (PARTITION BY host, t, own, after) AS cell_n, sum(n) OVER (PARTITION BY host, t, own) AS own_n,
        sum(n) OVER (PARTITION BY host, t, after) AS shape_n, sum(n) OVER (PARTITION BY host, t) AS all_n,
        count(DISTINCT own) OVER (PARTITION BY host, t) AS siblings,
        row_number() OVER (PARTITION BY host, t, own, after ORDER BY raw) = 1 AS first
      FROM (
        SELECT *, coalesce(raw[level + 1], '{ut.ABSENT}') AS own,
          {shape.format(f"coalesce(raw[level + 2], '{ut.ABSENT}')")} AS after
        FROM tree WHERE level < (SELECT depth FROM overall))))),
done AS (SELECT tree.* FROM tree, overall WHERE level = depth),
merged AS (
  SELECT host, t, (sum(bad) + {ut.SMOOTHING} * any_value(share)) / (sum(known) + {ut.SMOOTHING}) AS purity
  FROM done JOIN leaves USING (host, raw), overall GROUP BY host, t)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN purity >= {ut.BLOCK_FROM} THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN t = '' THEN '/' ELSE t END AS template, purity
FROM judged JOIN done USING (host, raw) JOIN merged USING (host, t)"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    bit = "lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))"
    step = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], {bit})"
    codes = f"[ord(d)::UBIGINT FOR d IN string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), {step}), 4294967295::UBIGINT)"


def _climb(name: str, above: str, nodes: str, start: str, same: str) -> str:
    """Every row with its way up in `nodes`: the claimed digest folded, and the neighbours' digests."""
    hashed = f"CASE WHEN m.h IS NULL THEN {name}.h WHEN {name}.idx % 2 = 0 THEN {name}.h || m.h ELSE m.h || {name}.h END"
    return f"""
{name} AS (
  {start} FROM {above}
  UNION ALL
  SELECT doc_id, {name}.lang, {name}.level + 1, {name}.idx // 2, ({name}.n + 1) // 2, sha256({hashed}), proof || coalesce(m.h, '')
  FROM {name} LEFT JOIN {nodes} m ON m.level = {name}.level AND m.idx = xor({name}.idx, 1) AND {same}
  WHERE {name}.n > 1)"""


def _merkle_manifest() -> str:
    altered = f"{_crc32('doc_id::VARCHAR')} % 7 = 0"
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN {altered} THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
tree AS (
  SELECT lang, 0 AS level, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1
  GROUP BY lang, level, idx // 2),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (
  SELECT 0 AS level, idx, n, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM crown WHERE n > 1
  GROUP BY level, idx // 2),
{_climb("low", "leaves", "tree", "SELECT doc_id, lang, 0 AS level, idx, n, claimed AS h, '' AS proof", "m.lang IS NOT DISTINCT FROM low.lang")},
tops AS (
  SELECT doc_id, low.lang, s.idx, s.n, low.h, proof FROM low JOIN subroots s ON s.lang IS NOT DISTINCT FROM low.lang WHERE low.n = 1),
{_climb("high", "tops", "crown", "SELECT doc_id, lang, 0 AS level, idx, n, h, proof", "true")}
SELECT leaves.doc_id, leaf, s.h AS subroot, c.h AS root, sha256(proof) AS proof_sha256, high.h AS folded_root, high.h = c.h AS verified
FROM high JOIN leaves USING (doc_id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang JOIN crown c ON c.n = 1
WHERE high.n = 1"""


def llm_oracles() -> dict[str, str]:
    return {"op7_url_templates": _url_templates(), "op11_merkle_manifest": _merkle_manifest()}
