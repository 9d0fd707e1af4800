"""SQL of the checks: the rules told again, row by row, for the checking engine.

The recursive parts walk each group in order, one entry per step, as the rules are
worded. They share no plan with the Spark operators.
"""

CONTRACTS = """
contracts AS MATERIALIZED (
SELECT o_orderkey AS id,
       lower(n_name) AS owner_acronym,
       c_mktsegment || ' ' || cast(c_custkey % 7 AS string)
         || CASE o_orderkey % 3 WHEN 0 THEN ' LTD' WHEN 1 THEN ', INC.' ELSE '' END AS vendor_name,
       c_mktsegment || ' ' || cast(c_custkey % 7 AS string) AS gen_vendor_normalized,
       cast(floor(o_totalprice / 10000) * 5000 AS double) AS contract_value,
       cast(CASE WHEN o_orderkey % 5 = 0 THEN floor(o_totalprice / 20000) * 5000 END AS double) AS original_value,
       'R' || cast(o_orderkey % 400 AS string) AS reference_number,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            ELSE cast(year(o_orderdate) AS string) || '-' || lpad(cast(month(o_orderdate) AS string), 2, '0') END AS raw_contract_date,
       cast(year(o_orderdate) AS int) AS source_year,
       cast(quarter(o_orderdate) AS int) AS source_quarter,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            ELSE cast(year(o_orderdate) AS string) || lpad(cast((year(o_orderdate) + 1) % 100 AS string), 2, '0')
                 || '-Q' || cast(quarter(o_orderdate) AS string) END AS source_fiscal,
       cast(1 + o_orderkey % 2 AS int) AS source_origin,
       cast(year(o_orderdate) AS int) AS gen_start_year,
       cast(year(o_orderdate) + o_orderkey % 5 - 1 AS int) AS gen_end_year
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

FLAGGED = """
flagged AS MATERIALIZED (
SELECT *, source_fiscal IS NULL OR contract_value = 0 AS gen_is_error,
       cast(CASE WHEN source_fiscal IS NULL THEN 2 WHEN contract_value = 0 THEN 3 END AS int) AS gen_error_via
FROM contracts)"""

DUPLICATES = """
d_in AS MATERIALIZED (
SELECT *, row_number() OVER (PARTITION BY owner_acronym, contract_value ORDER BY source_fiscal, id) AS rn,
       count(*) OVER (PARTITION BY owner_acronym, contract_value) AS n
FROM flagged WHERE NOT gen_is_error AND source_fiscal IS NOT NULL),
d_walk AS (
SELECT owner_acronym, contract_value, n, cast(1 AS bigint) AS step,
       [{'id': id, 'v': gen_vendor_normalized, 'd': raw_contract_date, 'r': reference_number, 'y': gen_start_year}] AS kept
FROM d_in WHERE rn = 1
UNION ALL
SELECT w.owner_acronym, w.contract_value, w.n, w.step + 1,
       CASE WHEN len(list_filter(w.kept, lambda k: (k.v IS NOT DISTINCT FROM x.gen_vendor_normalized
                     AND k.d IS NOT DISTINCT FROM x.raw_contract_date)
                     OR k.r IS NOT DISTINCT FROM x.reference_number)) > 0 THEN w.kept
            ELSE list_append(w.kept, {'id': x.id, 'v': x.gen_vendor_normalized, 'd': x.raw_contract_date,
                                      'r': x.reference_number, 'y': x.gen_start_year}) END
FROM d_walk w JOIN d_in x ON x.owner_acronym = w.owner_acronym AND x.contract_value = w.contract_value
     AND x.rn = w.step + 1),
d_match AS (
SELECT x.id, x.gen_vendor_normalized AS v, x.raw_contract_date AS d, x.gen_start_year AS y,
       list_filter(w.kept, lambda k: (k.v IS NOT DISTINCT FROM x.gen_vendor_normalized
             AND k.d IS NOT DISTINCT FROM x.raw_contract_date)
             OR k.r IS NOT DISTINCT FROM x.reference_number)[1] AS keeper
FROM d_in x JOIN d_walk w ON x.owner_acronym = w.owner_acronym AND x.contract_value = w.contract_value AND w.step = w.n),
marked AS MATERIALIZED (
SELECT f.*, m.id IS NOT NULL AS gen_is_duplicate,
       cast(CASE WHEN m.id IS NULL THEN NULL
            WHEN m.keeper.v IS NOT DISTINCT FROM m.v AND m.keeper.d IS NOT DISTINCT FROM m.d THEN 1
            WHEN m.keeper.v IS NOT DISTINCT FROM m.v AND m.keeper.y IS NOT DISTINCT FROM m.y THEN 2
            ELSE 3 END AS int) AS gen_duplicate_via,
       m.keeper.id AS gen_duplicate_source_id
FROM flagged f LEFT JOIN (SELECT * FROM d_match WHERE keeper.id <> id) m ON f.id = m.id)"""

AMENDMENTS = """
a_in AS MATERIALIZED (
SELECT owner_acronym AS o, gen_vendor_normalized AS v,
       list({'id': id, 'r': reference_number, 'c': contract_value, 'g': original_value, 'y': gen_start_year}
            ORDER BY source_fiscal, id) AS e
FROM marked WHERE NOT gen_is_error AND NOT gen_is_duplicate AND source_fiscal IS NOT NULL GROUP BY 1, 2),
a_walk AS (
SELECT o, v, e, cast(1 AS bigint) AS step, list_transform(e, lambda x: cast(NULL AS bigint)) AS owner_of FROM a_in
UNION ALL
SELECT o, v, e, step + 1,
       CASE WHEN owner_of[step] IS NOT NULL OR len(wanted) = 0 THEN owner_of
            ELSE list_transform(range(1, len(e) + 1), lambda j:
                 CASE WHEN j = step OR list_contains(wanted, j) THEN step ELSE owner_of[j] END) END
FROM (SELECT *, list_filter(range(1, len(e) + 1), lambda j: j <> step AND owner_of[j] IS NULL
             AND (e[j].r IS NOT DISTINCT FROM e[step].r
                  OR (e[j].g IS NOT DISTINCT FROM e[step].c AND e[j].y IS NOT DISTINCT FROM e[step].y))) AS wanted
      FROM a_walk WHERE step <= len(e))),
a_flat AS (
SELECT unnest(list_transform(range(1, len(e) + 1), lambda j: {'id': e[j].id, 'grp': e[owner_of[j]].id})) AS p
FROM a_walk WHERE step = len(e) + 1),
linked AS MATERIALIZED (
SELECT m.*, coalesce(a.grp <> m.id, false) AS gen_is_amendment,
       cast(CASE WHEN a.grp <> m.id THEN 1 END AS int) AS gen_amendment_via,
       a.grp AS gen_amendment_group_id
FROM marked m LEFT JOIN (SELECT p.id AS id, p.grp AS grp FROM a_flat) a ON m.id = a.id)"""

EFFECTIVE = """
e_rows AS MATERIALIZED (
SELECT *, CASE WHEN gen_end_year < gen_start_year THEN greatest(gen_start_year, source_year) ELSE gen_end_year END AS fixed_end,
       row_number() OVER (PARTITION BY gen_amendment_group_id ORDER BY source_fiscal, contract_value, id) AS pos,
       count(*) OVER (PARTITION BY gen_amendment_group_id) AS members
FROM linked WHERE NOT gen_is_error AND NOT gen_is_duplicate AND source_fiscal IS NOT NULL),
e_span AS (
SELECT gen_amendment_group_id AS grp, min(gen_start_year) AS lo, max(CASE WHEN pos = members THEN fixed_end END) AS hi,
       coalesce(nullif(min(original_value), 0), min(contract_value)) AS original
FROM e_rows WHERE gen_amendment_group_id IS NOT NULL GROUP BY 1),
e_years AS (SELECT grp, lo, hi, original, unnest(generate_series(lo, hi)) AS yr FROM e_span),
e_owner AS (
SELECT y.grp, y.yr, y.original, max(r.pos) AS pos
FROM e_years y JOIN e_rows r ON r.gen_amendment_group_id = y.grp
 AND y.yr BETWEEN CASE WHEN r.pos = 1 THEN r.gen_start_year ELSE r.source_year END AND r.fixed_end
GROUP BY 1, 2, 3),
e_owned AS MATERIALIZED (
SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pos) AS k FROM (
SELECT r.id, o.grp, o.original, r.pos, r.members, r.contract_value, r.gen_start_year, r.source_year, r.fixed_end,
       min(o.yr) AS eff_start, max(o.yr) AS eff_end
FROM e_owner o JOIN e_rows r ON r.gen_amendment_group_id = o.grp AND r.pos = o.pos
GROUP BY ALL)),
e_walk AS (
SELECT id, grp, k, contract_value / (fixed_end - gen_start_year + 1) * (eff_end - eff_start + 1) AS total,
       contract_value / (fixed_end - gen_start_year + 1) * (eff_end - eff_start + 1) AS spent
FROM e_owned WHERE k = 1
UNION ALL
SELECT n.id, n.grp, n.k, (n.contract_value - w.spent) / (n.fixed_end - n.source_year + 1) * (n.eff_end - n.eff_start + 1),
       w.spent + (n.contract_value - w.spent) / (n.fixed_end - n.source_year + 1) * (n.eff_end - n.eff_start + 1)
FROM e_walk w JOIN e_owned n ON n.grp = w.grp AND n.k = w.k + 1),
enriched AS MATERIALIZED (
SELECT l.*,
  cast(CASE WHEN r.id IS NULL THEN NULL WHEN l.gen_amendment_group_id IS NULL THEN r.gen_start_year ELSE o.eff_start END AS int) AS gen_effective_start_year,
  cast(CASE WHEN r.id IS NULL THEN NULL WHEN l.gen_amendment_group_id IS NULL THEN r.fixed_end ELSE o.eff_end END AS int) AS gen_effective_end_year,
  CASE WHEN r.id IS NULL THEN NULL WHEN l.gen_amendment_group_id IS NULL THEN r.contract_value ELSE coalesce(w.total, 0) END AS gen_effective_total_value,
  CASE WHEN r.id IS NULL THEN NULL WHEN l.gen_amendment_group_id IS NULL THEN r.contract_value / (r.fixed_end - r.gen_start_year + 1)
       ELSE coalesce(w.total / (o.eff_end - o.eff_start + 1), 0) END AS gen_effective_yearly_value,
  CASE WHEN r.id IS NULL THEN NULL WHEN l.gen_amendment_group_id IS NULL THEN coalesce(nullif(r.original_value, 0), r.contract_value)
       ELSE o.original END AS gen_original_value,
  CASE WHEN r.id IS NULL THEN false WHEN l.gen_amendment_group_id IS NULL THEN true
       ELSE coalesce(o.pos = o.members, false) END AS gen_is_most_recent_value
FROM linked l LEFT JOIN e_rows r ON l.id = r.id LEFT JOIN e_owned o ON l.id = o.id LEFT JOIN e_walk w ON l.id = w.id)"""

EXPORTS = """
v1 AS (
SELECT gen_vendor_normalized AS vendor_normalized, owner_acronym, gen_effective_total_value AS effective_total_value,
       gen_effective_yearly_value AS effective_yearly_value, original_value,
       gen_effective_start_year AS effective_start_year, gen_effective_end_year AS effective_end_year,
       source_fiscal, source_year, source_quarter, source_origin,
       cast(gen_is_most_recent_value AS int) AS is_most_recent_value, cast(gen_is_amendment AS int) AS is_amendment,
       gen_amendment_group_id AS amendment_group_id, reference_number
FROM enriched WHERE NOT gen_is_duplicate AND NOT gen_is_error AND source_fiscal IS NOT NULL),
v2 AS (
SELECT vendor_normalized, owner_acronym, source_fiscal, source_year, source_quarter, source_origin, is_amendment,
       amendment_group_id, reference_number, effective_yearly_value AS yearly_value,
       cast(unnest(generate_series(effective_start_year, effective_end_year)) AS int) AS effective_year
FROM v1 WHERE effective_start_year <> 0 AND effective_end_year <> 0)"""

STAGES = {
    "contracts": [CONTRACTS],
    "flagged": [CONTRACTS, FLAGGED],
    "marked": [CONTRACTS, FLAGGED, DUPLICATES],
    "linked": [CONTRACTS, FLAGGED, DUPLICATES, AMENDMENTS],
    "enriched": [CONTRACTS, FLAGGED, DUPLICATES, AMENDMENTS, EFFECTIVE],
    "exports": [CONTRACTS, FLAGGED, DUPLICATES, AMENDMENTS, EFFECTIVE, EXPORTS],
}


def after(stage: str, select: str, *more: str) -> str:
    """A SELECT over the tables known after a stage, plus further WITH parts."""
    return "WITH RECURSIVE " + ",".join([*STAGES[stage], *more]) + "\n" + select.strip()
