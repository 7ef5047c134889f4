"""DuckDB SQL for each query of the catalog, written from the definition and not from the Spark plan."""

from __future__ import annotations

# Named subqueries; each may use the ones before it.
CTES = {
    "customers": """
        SELECT c_custkey k, c_nationkey nk, n_regionkey rk, c_name name, 'C' || c_custkey area
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "base": """
        SELECT o_custkey k, c_nationkey nk, CAST(year(o_orderdate) AS INT) yr,
               CAST(o_totalprice AS DECIMAL(18,2)) p, o_orderstatus st, o_orderpriority pr
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "full_cube": """
        SELECT k, nk, e, yr,
               sum(CASE WHEN e = '511' OR (e = '512') = (st = 'F') AND e IN ('512', '513')
                          OR (e = '561') = (pr IN ('1-URGENT', '2-HIGH')) AND e IN ('551', '561') THEN p ELSE 0 END) v
        FROM base CROSS JOIN (SELECT unnest(['511', '512', '513', '551', '561']) e)
        GROUP BY k, nk, e, yr""",
    "leaf": """
        SELECT k, nk, 'C' || k a, e, yr, CASE WHEN k % 211 = 0 AND yr = 1996 THEN NULL ELSE v END v,
               CASE WHEN k % 13 = 0 THEN '' WHEN yr >= 2000 THEN 'E' ELSE 'X' END s, 'h' m
        FROM full_cube
        WHERE NOT (e IN ('512', '513') AND k % 7 = 3 AND nk % 3 = 0)
          AND NOT (e IN ('551', '561') AND k % 11 = 4 AND nk % 4 = 1)
          AND NOT (e = '513' AND k % 101 = 5)""",
    "hier": """
        SELECT 'R' || rk l3, CASE WHEN rk < 3 THEN 'N' || nk WHEN nk % 2 = 0 THEN '' END l4, area l5,
               CASE WHEN rk < 3 THEN 'N' || nk ELSE 'R' || rk END parent
        FROM customers""",
    "published": """
        SELECT parent, e, yr, sum(v) v FROM full_cube JOIN hier ON 'C' || k = l5 GROUP BY parent, e, yr""",
    "source": """
        SELECT a, e, yr, v, s, m FROM leaf UNION ALL SELECT 'U' || parent, e, yr, v, 'X', 'h' FROM published""",
    "conversion": """
        SELECT DISTINCT CASE WHEN n_regionkey < 3 THEN 'N' || n_nationkey ELSE 'R' || n_regionkey END parent
        FROM nation WHERE n_nationkey <> 6 OR n_regionkey >= 3""",
    "area_codes": """
        SELECT area code, CASE WHEN k % 41 = 0 THEN NULL ELSE name END description,
               CASE WHEN k % 29 = 0 THEN 'region' ELSE 'country' END "type", k % 31 = 0 "selectionOnly",
               CASE WHEN k % 37 = 0 THEN '1999' END "endDate"
        FROM customers WHERE k % 43 <> 0""",
    "crosswalk": """
        SELECT t.code, s.source_description, t.target_description, s.code source_code,
               coalesce(s.source_description = t.target_description, false) OR coalesce(t.k % 100 = 0, false) compliant
        FROM (SELECT area code, CASE WHEN k % 71 = 3 THEN NULL ELSE name END source_description FROM customers WHERE k % 97 <> 1) s
        FULL JOIN (SELECT k, area code,
                          CASE WHEN k % 50 = 0 THEN name || '*'
                               WHEN k % 100 = 51 THEN 'Customer#' || lpad(CAST(k - 1 AS VARCHAR), 9, '0')
                               ELSE name END target_description
                   FROM customers WHERE k % 89 <> 2) t ON s.code = t.code""",
    "reporting": """
        SELECT * FROM source WHERE a IN (SELECT code FROM crosswalk WHERE compliant AND code IS NOT NULL)""",
    "weights": """
        SELECT * FROM (VALUES ('X', 1.0), ('E', 0.5), ('', 1.0)) t(flag, weight)""",
    "residuals": """
        SELECT p.parent || '.01' a, p.e, p.yr, p.v - r.v v, r.s, r.m
        FROM published p JOIN conversion USING (parent) JOIN (
            SELECT h.parent, c.e, c.yr, CASE WHEN count(*) = count(c.v) THEN sum(c.v) END v,
                   arg_min(c.s, weight * 1000 + ascii(c.s || ' ')) s, min(c.m) m
            FROM reporting c JOIN hier h ON c.a = h.l5 JOIN weights ON c.s = flag
            WHERE (c.e IN ('512', '513') AND h.parent IN (
                       SELECT parent FROM hier WHERE l5 IN (SELECT a FROM reporting WHERE e = '511')
                          AND l5 NOT IN (SELECT a FROM reporting WHERE e = '512')))
               OR (c.e IN ('551', '561') AND h.parent IN (
                       SELECT parent FROM hier WHERE l5 IN (SELECT a FROM reporting WHERE e = '511')
                          AND l5 NOT IN (SELECT a FROM reporting WHERE e = '561')))
            GROUP BY h.parent, c.e, c.yr) r ON p.parent = r.parent AND p.e = r.e AND p.yr = r.yr
        WHERE p.v - r.v IS NOT NULL AND (p.e IN ('512', '513') OR p.v - r.v <> 0)""",
    "operational": """
        SELECT * FROM reporting UNION ALL SELECT * FROM residuals
        UNION ALL SELECT 'C1248x', e, yr, v, s, m FROM reporting WHERE a = 'C7'""",
    "wide_cells": """
        SELECT a, e, y.yr, CASE WHEN k % 67 = 0 AND y.yr = 1996 THEN NULL ELSE v END v, k
        FROM (SELECT DISTINCT k, a, e FROM leaf) x CROSS JOIN (SELECT CAST(unnest(range(1995, 2002)) AS INT) yr) y
        LEFT JOIN (SELECT k, e, yr, v FROM leaf) l USING (k, e, yr)""",
    "estimates": """
        SELECT a, e, yr, v, CASE WHEN e IN ('511', '512', '513') THEN 'Estimates' END variant
        FROM wide_cells WHERE yr <= 1998 OR e IN ('551', '561')""",
    "medium": """
        SELECT a, e, yr, CASE WHEN k % 37 = 0 AND yr = 1998 THEN 1234.5 ELSE v END v, 'Medium variant' variant
        FROM wide_cells WHERE yr >= 1998 AND e IN ('511', '512', '513')""",
    "spliced": """
        SELECT * FROM estimates UNION ALL SELECT * FROM medium WHERE yr <> 1998""",
    "validity": """
        SELECT area m49, s, t FROM customers, LATERAL (
            SELECT * FROM (VALUES (0, NULL, 1999), (1, 1997, NULL), (2, NULL, 1996), (2, 1996, 1996), (2, 1998, NULL),
                                  (3, NULL, NULL), (4, NULL, NULL)) x(r, s, t) WHERE r = k % 5) WHERE k % 24 <> 0""",
    "area_groups": """
        SELECT 'G' || nk g, area m FROM customers UNION ALL SELECT 'GR' || rk, area FROM customers
        UNION ALL SELECT '953', area FROM customers
        UNION ALL SELECT '953', CASE WHEN k % 7 = 0 THEN area END FROM customers
        UNION ALL SELECT 'GR' || n_regionkey, 'G' || n_nationkey FROM nation""",
    "members": """
        SELECT DISTINCT g, m FROM area_groups WHERE m IS NOT NULL AND m NOT IN (SELECT g FROM area_groups)""",
    "factors": """
        SELECT * FROM (VALUES ('I1', 'ECONOMY', 1.0), ('I1', 'PROMO', NULL), ('I1', 'STANDARD', 0.5), ('I2', 'SMALL', 0.33333333),
                              ('I2', 'MEDIUM', 2.0), ('I2', 'STANDARD', 0.00004)) t(ig, item, factor)""",
    "items": """
        SELECT k, CASE WHEN k % 61 = 0 THEN 'GR1' ELSE 'C' || k END a, e, item, yr,
               CASE WHEN e = '5312' AND k % 19 = 4 THEN NULL
                    WHEN e = '5622' AND item = 'LARGE' AND k % 2 = 0 THEN NULL
                    WHEN e IN ('5510', '5622') THEN x WHEN e = '5419' THEN 0 ELSE q END v,
               CASE WHEN k % 13 = 0 THEN NULL WHEN yr >= 2000 THEN 'E' ELSE 'X' END s, 'h' m
        FROM (SELECT o_custkey k, CAST(year(l_shipdate) AS INT) yr,
                     CASE WHEN p_partkey % 40 = 0 THEN 'I1' WHEN p_partkey % 53 = 0 THEN 'AH01' ELSE p_type END item,
                     sum(CAST(l_extendedprice AS DECIMAL(18,2))) x, sum(CAST(l_quantity AS DECIMAL(18,2))) q
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
             (SELECT unnest(['5510', '5312', '5622', '5419', '5999']) e)
        WHERE e <> '5419' OR k % 25 <> 0""",
    # Valid years, no existing aggregates.
    "clean_items": """
        SELECT * FROM items i
        WHERE EXISTS (SELECT 1 FROM validity w WHERE w.m49 = i.a AND (s IS NULL OR i.yr >= w.s) AND (t IS NULL OR i.yr <= w.t))
          AND a NOT IN (SELECT g FROM area_groups) AND item NOT IN ('I1', 'I2', 'AH01')""",
    "listed_areas": """
        SELECT area, flag FROM (
            SELECT k, area, CASE WHEN k % 17 = 0 THEN 0 WHEN k % 18 = 0 THEN NULL WHEN k % 2 = 0 THEN 99 ELSE 1 END flag
            FROM customers WHERE k % 33 <> 0) WHERE flag <> 0""",
}

CUBE = (
    'a "geographicAreaM49", e "measuredElement", yr "timePointYears", CAST(v AS DOUBLE) "Value", '
    's "flagObservationStatus", m "flagMethod"'
)
FLAGS = 's "flagObservationStatus", m "flagMethod"'
ORACLES: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    """Store `body` with the subqueries it needs."""
    needed, text = [], body
    for cte in reversed(CTES):
        if cte in text:
            needed.insert(0, f"{cte} AS ({CTES[cte]})")
            text += CTES[cte]
    ORACLES[name] = f"WITH {', '.join(needed)} {body}"


# --- sources and sinks ---

oracle(
    "src_wide_csv",
    """SELECT 'Estimates' "Variant", a "Country code", """
    + ", ".join(
        f"""max(CASE WHEN yr = {y} THEN CASE WHEN k % 67 = 0 AND yr = 1996 THEN '..'
            ELSE replace(format('{{:,.2f}}', CAST(v AS DOUBLE)), ',', ' ') END END) "{y}" """
        if y != 1996
        else f"""CASE WHEN k % 67 = 0 THEN '..' ELSE
            max(CASE WHEN yr = {y} THEN replace(format('{{:,.2f}}', CAST(v AS DOUBLE)), ',', ' ') END) END "{y}" """
        for y in range(1995, 2002)
    )
    + """, e "measuredElement" FROM leaf GROUP BY a, k, e""",
)
oracle(
    "sink_roundtrip",
    """SELECT yr "timePointYears", e "measuredElement", count(*) n,
              CAST(sum(CASE WHEN yr = 1998 THEN 2 * v ELSE v END) AS DOUBLE) total FROM leaf GROUP BY yr, e
       UNION ALL SELECT 0, 'rules', 2 * count(*), NULL FROM conversion
       UNION ALL SELECT 0, 'report', count(*), NULL FROM area_codes""",
)
oracle(
    "cube_slice",
    f"""SELECT {CUBE} FROM leaf WHERE e IN ('511', '561') AND yr BETWEEN 1997 AND 1999
        AND a IN (SELECT code FROM area_codes WHERE "type" = 'country')""",
)
oracle(
    "codelist_filter",
    """SELECT * FROM area_codes WHERE "type" = 'country' AND NOT "selectionOnly" AND "endDate" IS NULL""",
)

# --- ingest ---

oracle(
    "ingest_unpivot",
    """SELECT a "geographicAreaM49", e "measuredElement", yr "timePointYears", CAST(coalesce(v, 0) AS DOUBLE) "Value",
              CASE WHEN v IS NULL THEN 'O' ELSE 'X' END "flagObservationStatus", 'h' "flagMethod"
       FROM spliced WHERE a IN (SELECT code FROM area_codes)""",
)
METADATA = """'GENERAL' "Metadata", 'COMMENT' "Metadata_Element", 'en' "Metadata_Language",
       row_number() OVER (ORDER BY a, e, yr, txt) "Metadata_Group", txt "Metadata_Value" """
oracle(
    "ingest_metadata",
    f"""SELECT a "geographicAreaM49", e "measuredElement", yr "timePointYears", {METADATA}
        FROM (SELECT *, concat_ws('-', CASE WHEN e IN ('551', '561') THEN 'WUP2018' ELSE 'WPP2019' END, variant) txt
              FROM spliced WHERE a IN (SELECT code FROM area_codes))""",
)
oracle(
    "splice_estimate_projection",
    """SELECT variant "Variant", a "geographicAreaM49", yr "timePointYears", CAST(v AS DOUBLE) "Value", e "measuredElement"
       FROM spliced""",
)
oracle(
    "overlap_check",
    """SELECT a "geographicAreaM49", e "measuredElement", yr "timePointYears", CAST(v AS DOUBLE) "Value", side FROM (
           SELECT *, 'estimates' side FROM (
               SELECT a, e, yr, v FROM estimates WHERE yr = 1998 AND e IN ('511', '512', '513')
               EXCEPT SELECT a, e, yr, v FROM medium WHERE yr = 1998)
           UNION ALL SELECT *, 'projections' FROM (
               SELECT a, e, yr, v FROM medium WHERE yr = 1998
               EXCEPT SELECT a, e, yr, v FROM estimates WHERE yr = 1998))""",
)
ORACLES["ingest_overlaps"] = ORACLES["overlap_check"]
oracle(
    "country_only",
    f"""SELECT {CUBE} FROM leaf WHERE a IN (SELECT code FROM area_codes
        WHERE "type" = 'country' AND NOT "selectionOnly" AND description IS NOT NULL)""",
)
oracle(
    "unknown_codes",
    'SELECT DISTINCT a "geographicAreaM49" FROM leaf WHERE a NOT IN (SELECT code FROM area_codes)',
)

# --- reshape and scalar clean-up ---

oracle(
    "pivot_elements",
    'SELECT a "geographicAreaM49", yr "timePointYears", '
    + ", ".join(f"CAST(max(v) FILTER (e = '{e}') AS DOUBLE) \"{e}\"" for e in (511, 512, 513, 551, 561))
    + " FROM leaf GROUP BY a, yr",
)
oracle(
    "fill_missing_flag",
    """SELECT a "geographicAreaM49", e "measuredElement", yr "timePointYears", CAST(coalesce(v, 0) AS DOUBLE) "Value",
              CASE WHEN v IS NULL THEN 'O' ELSE s END "flagObservationStatus", m "flagMethod" FROM leaf""",
)
oracle(
    "alias_area",
    f"""SELECT {CUBE} FROM (
        SELECT a, e, yr, v, s, m FROM leaf UNION ALL
        SELECT x.n, e, yr, v, s, m FROM leaf JOIN (VALUES ('C7', 'C1248'), ('C7', 'X7'), ('C10', 'X10')) x(o, n) ON a = o)""",
)
oracle(
    "recode_codes",
    f"SELECT {CUBE} FROM (SELECT CASE WHEN k % 9 = 0 THEN 'D' || k ELSE a END a, e, yr, v, s, m FROM leaf)",
)
oracle(
    "recode_dropping",
    f"SELECT {CUBE} FROM (SELECT 'D' || k a, e, yr, v, s, m FROM leaf WHERE k % 9 = 0)",
)
oracle(
    "totals_by_validity",
    """SELECT areas, CAST(n AS BIGINT) n, CAST(total AS DOUBLE) total FROM (
           SELECT coalesce(kind, 'all') areas, count(*) n, sum(v) total FROM (
               SELECT v, CASE WHEN a IN (SELECT m49 FROM validity) AND a NOT IN (SELECT m49 FROM validity WHERE t IS NULL)
                              THEN 'ended' ELSE 'open' END kind FROM leaf WHERE e = '511')
           GROUP BY GROUPING SETS ((kind), ()))""",
)
ORACLES["src_below_preamble"] = """SELECT 'C' || c_custkey "Country code", CAST(c_nationkey AS VARCHAR) nation FROM customer"""
ORACLES["src_quoted_preamble"] = """SELECT replace(c_name, '#', chr(10) || '"') || ', x' AS name, 'C' || c_custkey "Country code" FROM customer"""
ORACLES["src_typed_csv"] = """SELECT 'C' || c_custkey "Code", CASE WHEN c_custkey % 10 <> 3 THEN CAST(c_custkey AS DOUBLE) END "Key" FROM customer"""
ORACLES["ingest_from_folder"] = ORACLES["ingest_unpivot"]
oracle(
    "release_roundtrip",
    """SELECT yr "timePointYears", 'cube' part, count(*) n, CAST(sum(CASE WHEN yr = 1998 THEN 2 * v ELSE v END) AS DOUBLE) total FROM leaf GROUP BY yr
       UNION ALL SELECT yr, CASE WHEN yr = 1998 THEN 'second' ELSE 'first' END, count(*), NULL FROM leaf WHERE yr <> 1998 OR e = '511' GROUP BY yr""",
)
oracle(
    "validity_disjoint",
    """SELECT m49, CASE WHEN min(f) > -99999 THEN CAST(min(f) AS VARCHAR) END start_year, CASE WHEN max(l) < 99999 THEN CAST(max(l) AS VARCHAR) END end_year FROM (
           SELECT *, sum(CASE WHEN f <= before + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY m49 ORDER BY f, l) run FROM (
               SELECT *, max(l) OVER (PARTITION BY m49 ORDER BY f, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) before FROM (
                   SELECT m49, coalesce(s, -99999) f, coalesce(t, 99999) l FROM validity)))
       GROUP BY m49, run""",
)
LABELLED = f"""SELECT {CUBE}, d.description "geographicAreaM49_description", n.description "measuredElement_description"
    FROM leaf LEFT JOIN area_codes d ON a = d.code
    LEFT JOIN (VALUES ('511', 'Total'), ('512', 'Male'), ('513', 'Female'), ('561', 'Urban')) n(code, description)
    ON e = n.code"""
oracle("label_join", LABELLED)
oracle(
    "label_list",
    'SELECT DISTINCT d.description "geographicAreaM49_description" FROM leaf LEFT JOIN area_codes d ON a = d.code ORDER BY 1',
)
oracle(
    "unlabelled_codes",
    'SELECT DISTINCT a "geographicAreaM49" FROM leaf LEFT JOIN area_codes d ON a = d.code WHERE d.description IS NULL',
)
oracle("head_rows", f"SELECT {CUBE} FROM leaf ORDER BY a, e, yr LIMIT 10")
oracle("year_bounds", "SELECT min(yr) start_year, max(yr) end_year FROM leaf")
oracle(
    "valid_area_years",
    f"""SELECT {CUBE} FROM leaf WHERE EXISTS (SELECT 1 FROM validity w WHERE w.m49 = leaf.a
        AND (w.s IS NULL OR leaf.yr >= w.s) AND (w.t IS NULL OR leaf.yr <= w.t))""",
)
oracle(
    "sum_strict",
    """SELECT parent, a "geographicAreaM49", e "measuredElement", yr "timePointYears", CAST(v AS DOUBLE) "Value",
              CAST(CASE WHEN count(*) OVER w = count(v) OVER w THEN sum(v) OVER w END AS DOUBLE) parent_total
       FROM leaf JOIN hier ON a = l5 WINDOW w AS (PARTITION BY parent, e, yr)""",
)

# --- crosswalk and coverage ---

oracle("crosswalk_compliance", "SELECT * FROM crosswalk")
oracle(
    "crosswalk_exceptions",
    """SELECT *, CASE WHEN source_code IS NULL THEN 'target_only' WHEN code IS NULL THEN 'source_only' ELSE 'differs' END "exception"
       FROM crosswalk WHERE source_code IS NULL OR code IS NULL OR source_description IS DISTINCT FROM target_description""",
)
oracle(
    "crosswalk_matched_elsewhere",
    """SELECT * FROM crosswalk WHERE NOT compliant AND target_description IN (
           SELECT source_description FROM crosswalk WHERE NOT compliant AND source_description IS NOT NULL)""",
)
oracle("compliant_filter", f"SELECT {CUBE} FROM reporting")
MISSING = """SELECT a, x e FROM (SELECT DISTINCT a FROM leaf WHERE e = '511') t, (SELECT unnest(['512', '513', '561', '551']) x)
    WHERE NOT EXISTS (SELECT 1 FROM leaf l WHERE l.a = t.a AND l.e = x)"""
oracle("coverage_missing", f'SELECT a "geographicAreaM49", e "measuredElement" FROM ({MISSING})')
oracle(
    "coverage_missing_cells",
    """SELECT t.a "geographicAreaM49", t.yr "timePointYears", x "measuredElement"
       FROM (SELECT a, yr FROM leaf WHERE e = '511') t CROSS JOIN (SELECT unnest(['512', '513', '561', '551']) x)
       LEFT JOIN leaf l ON l.a = t.a AND l.yr = t.yr AND l.e = x WHERE l.a IS NULL""",
)
ONE_SIDED = f"SELECT a, min(e) e FROM ({MISSING}) WHERE e IN ('512', '513') GROUP BY a HAVING count(*) = 1"
oracle("one_sided_sex", f'SELECT a "geographicAreaM49", e missing_element FROM ({ONE_SIDED})')
oracle(
    "coverage_report",
    f"""SELECT kind, a code,
               CASE kind WHEN 'sex' THEN 'Missing countries for male and female population: '
                         WHEN 'rural' THEN 'Missing rural countries: ' WHEN 'urban' THEN 'Missing urban countries: '
                         ELSE 'Problem! Countries ' END
               || a
               || CASE kind WHEN 'sex' THEN 'They will be included in the unspecified areas. '
                            WHEN 'one_sided' THEN ' are reporting only male or female population. ' ELSE '. ' END message
        FROM (SELECT CASE e WHEN '512' THEN 'sex' WHEN '551' THEN 'rural' ELSE 'urban' END kind, a FROM ({MISSING}) g
                WHERE e IN ('512', '551', '561') AND (SELECT count(*) FROM leaf WHERE e = '511')
                      <> (SELECT count(*) FROM leaf l WHERE l.e = g.e)
                UNION ALL SELECT 'one_sided', a FROM ({ONE_SIDED}))""",
)
GAPS = """SELECT DISTINCT parent, gap FROM hier, (SELECT unnest(['512', '561']) gap) WHERE l5 IN (SELECT a FROM leaf WHERE e = '511')
    AND NOT EXISTS (SELECT 1 FROM leaf WHERE a = l5 AND e = gap)"""
GAP = """SELECT parent FROM hier WHERE l5 IN (SELECT a FROM leaf WHERE e = '511')
    AND l5 NOT IN (SELECT a FROM leaf WHERE e = '512')"""
oracle("hier_mixed_level", f'SELECT h.parent, gap, l5 "member" FROM hier h JOIN ({GAPS}) g ON h.parent = g.parent')
oracle("hier_descendants", 'SELECT l3 parent, l5 "member" FROM hier')
oracle(
    "missing_residual_code",
    f"""SELECT DISTINCT parent, 'A new ''unspecified area'' code is required for area: ' || parent message
        FROM ({GAPS}) WHERE parent NOT IN (SELECT parent FROM conversion)""",
)
oracle(
    "country_year_coverage",
    """SELECT coalesce(a, code) code, CAST(v AS DOUBLE) "Value", description
       FROM (SELECT * FROM leaf WHERE yr = 1998 AND e = '511')
       FULL JOIN (SELECT * FROM area_codes WHERE "type" = 'country' AND "endDate" IS NULL) ON a = code""",
)
oracle(
    "missing_countries",
    """SELECT code, description, CAST(s AS VARCHAR) start_year, CAST(t AS VARCHAR) end_year FROM area_codes LEFT JOIN validity ON code = m49
       WHERE "type" = 'country' AND "endDate" IS NULL AND code NOT IN (SELECT a FROM leaf WHERE yr = 1998 AND e = '511')""",
)

# --- residual areas, aliases, metadata ---

oracle("residual_areas", f"SELECT {CUBE} FROM residuals")
oracle("operational_cube", f"SELECT {CUBE} FROM operational")
ORACLES["operational_slice"] = ORACLES["operational_cube"]
oracle(
    "metadata_build",
    f"""SELECT a "geographicAreaM49", e "measuredElement", yr "timePointYears", {METADATA}
        FROM (SELECT *, CASE WHEN a LIKE '%.01' THEN 'Residual variable aggregating unreported areas'
                             WHEN yr > 1999 THEN 'WPP-1999. Medium fertility variant '
                             WHEN e IN ('551', '561') THEN 'WUP-1997' ELSE 'WPP-1999' END txt FROM operational)""",
)
oracle(
    "identity_check",
    f"""SELECT parent, yr "timePointYears", CAST(parts AS DOUBLE) parts, CAST(total AS DOUBLE) total, parts = total holds
        FROM (SELECT parent, yr, sum(v) FILTER (e <> '511') parts, sum(v) FILTER (e = '511') total FROM (
                SELECT parent, e, yr, v FROM leaf JOIN hier ON a = l5 WHERE e IN ('511', '512', '513') AND parent IN ({GAP})
                UNION ALL
                SELECT parent, e, yr, p.v - x.v FROM published p JOIN (
                    SELECT parent, e, yr, CASE WHEN count(*) = count(v) THEN sum(v) END v
                    FROM leaf JOIN hier ON a = l5 WHERE parent IN ({GAP}) GROUP BY parent, e, yr) x USING (parent, e, yr)
                WHERE e IN ('512', '513') AND parent IN (SELECT parent FROM conversion))
              GROUP BY parent, yr)""",
)

# --- group aggregation ---


def aggregate_sql(
    rows: str, area: str | None, item: str | None, distinct: bool = False, groups: bool = False, strict: bool = False
) -> str:
    """Sum, ratio and flag per group over `rows` (a, e, item, yr, v, s, m and group columns).

    `area` and `item` are the output code expressions; None stands for one ad hoc code.
    """
    keys = [k for k in (area, item, "yr") if k]
    by = ", ".join(keys)
    named = f"{area or repr('AH01')} oa, {item or repr('AH01')} oi, yr"
    ig = ", coalesce(factor, 1.0) f" if groups else ", 1.0 f"
    return f"""
        WITH r AS ({rows}),
        w AS (SELECT *, CASE WHEN e = '5622' THEN 1.0 ELSE f END fe FROM (SELECT *{ig} FROM r)),
        own AS (SELECT {'DISTINCT' if distinct else ''} a, e, item, yr, v * fe v, s, m
                {', ' + area if area and area != 'a' else ''} {', ' + item if item and item != 'item' else ''} FROM w),
        cells AS (SELECT {'DISTINCT' if distinct else ''} n.a, n.item, n.yr, n.v * n.fe nv, d.v * d.fe dv
                  {', n.' + area if area and area != 'a' else ''} {', n.' + item if item and item != 'item' else ''}
                  FROM w n JOIN w d ON n.e = '5510' AND d.e = '5312' AND n.a = d.a AND n.item = d.item AND n.yr = d.yr
                  {'AND n.g = d.g' if area == 'g' else ''} {'AND n.ig IS NOT DISTINCT FROM d.ig' if groups else ''}
                  WHERE n.v IS NOT NULL AND d.v IS NOT NULL),
        ratios AS (SELECT {by}, CAST(sum(nv) AS DOUBLE) / nullif(CAST(sum(dv) AS DOUBLE), 0) * 10.0 q FROM cells GROUP BY {by}),
        sums AS (SELECT {by}, e, coalesce(sum(v), 0) v,
                        arg_min(coalesce(s, ''), CASE coalesce(s, '') WHEN 'E' THEN 0 WHEN '' THEN 1 ELSE 2 END) s
                 FROM own GROUP BY {by}, e)
        SELECT oa "geographicAreaM49", e "measuredElement", oi "measuredItemCPC", yr "timePointYears",
               CASE WHEN e = '5419' THEN q ELSE CAST(CAST(v AS DECIMAL(38,10)) AS DOUBLE) END "Value",
               s "flagObservationStatus", 'x' "flagMethod"
        FROM (SELECT {named}, e, v, s, q FROM sums LEFT JOIN ratios USING ({by}))
        WHERE e <> '5999' AND (e <> '5419' OR q IS NOT NULL)"""


LISTED_AREA = "a IN (SELECT area FROM listed_areas)"
LISTED_ITEM = "item IN ('ECONOMY', 'PROMO', 'STANDARD', 'SMALL')"
FULL_LISTED = "a IN (SELECT area FROM listed_areas WHERE flag = 99) AND item IN ('ECONOMY', 'STANDARD', 'SMALL')"
OWN = "c.k, c.a, c.e, c.item, c.yr, c.v, c.s, c.m"
PRESENT = "c.v IS NOT NULL AND c.s IS NOT NULL"
AREA_JOIN = "FROM clean_items c JOIN members ON c.a = members.m"
ITEM_JOIN = "LEFT JOIN factors ON c.item = factors.item"


def _aggregate_oracle(mode: str, body: str) -> None:
    """Put the inner subqueries behind the shared ones."""
    oracle(mode, "@" + body)
    head, tail = ORACLES[mode].split("@")
    ORACLES[mode] = head.rstrip() + ", " + tail.strip().removeprefix("WITH ")


_aggregate_oracle(
    "agg_adhoc_area",
    aggregate_sql(f"SELECT {OWN}, g {AREA_JOIN} WHERE {PRESENT} AND g = '953'", None, "item"),
)
_aggregate_oracle(
    "agg_adhoc_item",
    aggregate_sql(f"SELECT {OWN}, ig, factor FROM clean_items c {ITEM_JOIN}", "a", None, distinct=True, groups=True),
)
_aggregate_oracle(
    "agg_adhoc_area_item",
    aggregate_sql(
        f"SELECT {OWN}, g, ig, factor {AREA_JOIN} {ITEM_JOIN} WHERE {PRESENT} AND g = '953'",
        None,
        None,
        distinct=True,
        groups=True,
    ),
)
_aggregate_oracle(
    "agg_area",
    aggregate_sql(f"SELECT {OWN}, g {AREA_JOIN} WHERE {PRESENT} AND {LISTED_AREA} AND c.{LISTED_ITEM}", "g", "item"),
)
_aggregate_oracle(
    "agg_item",
    aggregate_sql(
        f"""SELECT {OWN}, ig, factor FROM clean_items c {ITEM_JOIN}
            WHERE ig IS NOT NULL AND {LISTED_AREA} AND c.{LISTED_ITEM}""",
        "a",
        "ig",
        groups=True,
    ),
)
_aggregate_oracle(
    "agg_area_item",
    aggregate_sql(
        f"""SELECT {OWN}, g, ig, factor {AREA_JOIN} {ITEM_JOIN}
            WHERE {PRESENT} AND ig IS NOT NULL AND {FULL_LISTED.replace("item IN", "c.item IN")}""",
        "g",
        "ig",
        groups=True,
    ),
)
_aggregate_oracle(
    "agg_session_item",
    aggregate_sql(
        f"""SELECT {OWN}, ig, factor FROM clean_items c {ITEM_JOIN}
            WHERE ig IS NOT NULL AND {LISTED_AREA} AND c.{LISTED_ITEM} AND c.yr BETWEEN 1996 AND 1999
            AND c.k IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE')""",
        "a",
        "ig",
        groups=True,
    ),
)
_aggregate_oracle(
    "agg_session_area",
    aggregate_sql(
        f"""SELECT {OWN}, g {AREA_JOIN} WHERE {PRESENT} AND {LISTED_AREA} AND c.item IN ('SMALL', 'PROMO')
            AND c.yr BETWEEN 1996 AND 1999 AND c.e = '5622' AND c.a IN (SELECT code FROM area_codes WHERE "type" = 'country')""",
        "g",
        "item",
    ),
)
ORACLES["agg_stored_rules"] = ORACLES["agg_session_area"]
POPULATION_GROUP = """SELECT {area} "geographicAreaM49", e "measuredElement", yr "timePointYears",
       CAST(sum(v) AS DOUBLE) "Value",
       arg_min(s, CASE s WHEN 'E' THEN 0 WHEN '' THEN 1 ELSE 2 END) "flagObservationStatus", 'x' "flagMethod"
    FROM leaf JOIN members ON a = members.m WHERE v IS NOT NULL AND {where} GROUP BY {area}, e, yr"""
oracle(
    "agg_population_area",
    POPULATION_GROUP.format(
        area="g",
        where="""EXISTS (SELECT 1 FROM validity w WHERE w.m49 = leaf.a AND (w.s IS NULL OR leaf.yr >= w.s)
                 AND (w.t IS NULL OR leaf.yr <= w.t))""",
    ),
)
oracle("agg_population_world", POPULATION_GROUP.format(area="'AH01'", where="g = '953'"))
oracle(
    "agg_ratio_element",
    """SELECT a "geographicAreaM49", yr "timePointYears", '5419' "measuredElement", n / nullif(d, 0) * 10.0 "Value" FROM (
           SELECT a, yr, CAST(sum(nv) AS DOUBLE) n, CAST(sum(dv) AS DOUBLE) d FROM (
               SELECT a, item, yr, sum(v) FILTER (e = '5510') nv, sum(v) FILTER (e = '5312') dv FROM items GROUP BY a, item, yr)
           WHERE nv IS NOT NULL AND dv IS NOT NULL GROUP BY a, yr)
       WHERE (a, yr) IN (SELECT (a, yr) FROM items WHERE e = '5419') AND d <> 0""",
)
oracle(
    "agg_flag",
    """SELECT a "geographicAreaM49", yr "timePointYears",
              arg_min(coalesce(s, ''), CASE coalesce(s, '') WHEN 'E' THEN 0 WHEN '' THEN 1 ELSE 2 END) "flagObservationStatus",
              'x' "flagMethod" FROM items GROUP BY a, yr""",
)
oracle(
    "expand_elements",
    "SELECT DISTINCT e code FROM items WHERE e IN ('5419', '5622', '5999', '5510', '5312')",
)
oracle("group_members_clean", "SELECT g group_code, m member_code FROM members")
oracle(
    "duplicate_members",
    """SELECT g group_code, m member_code, count(*) - 1 copies FROM area_groups GROUP BY g, m HAVING count(*) > 1""",
)
oracle(
    "duplicate_member_rows",
    "SELECT g group_code, m member_code, row_number() OVER (PARTITION BY g, m) > 1 later FROM area_groups",
)
oracle(
    "first_by_key",
    f"SELECT {CUBE} FROM leaf QUALIFY row_number() OVER (PARTITION BY a, e ORDER BY yr) = 1",
)
ITEM_CUBE = (
    'a "geographicAreaM49", e "measuredElement", item "measuredItemCPC", yr "timePointYears", CAST(v AS DOUBLE) "Value", '
    + FLAGS
)
oracle(
    "apply_factor",
    f"""SELECT {ITEM_CUBE}, ig item_group_code FROM (
            SELECT a, e, items.item item, yr, CASE WHEN e = '5622' THEN CAST(v AS DECIMAL(28,6))
                        ELSE CAST(v AS DECIMAL(28,6)) * coalesce(factor, 1.0) END v, s, m, ig
            FROM items LEFT JOIN factors ON items.item = factors.item)""",
)
oracle(
    "drop_existing_aggregates",
    f"""SELECT {ITEM_CUBE} FROM items WHERE a NOT IN (SELECT g FROM area_groups) AND item NOT IN ('I1', 'I2', 'AH01')""",
)
oracle(
    "dissemination_filter",
    """SELECT area code, 'any' "list" FROM listed_areas UNION ALL SELECT area, 'full' FROM listed_areas WHERE flag = 99""",
)
oracle("exclude_elements", f"SELECT {ITEM_CUBE} FROM items WHERE e NOT IN ('5999', '5998')")
oracle("excluded_elements", """SELECT DISTINCT e "measuredElement" FROM items WHERE e IN ('5999', '5998')""")
oracle(
    "group_list_compare",
    """SELECT coalesce(l.g, r.g) group_code, coalesce(l.area, r.area) member_code,
              CASE WHEN r.g IS NULL THEN 'left' WHEN l.g IS NULL THEN 'right' ELSE 'both' END side
       FROM (SELECT 'G' || nk g, area FROM customers) l
       FULL JOIN (SELECT 'G' || CASE WHEN k % 71 = 0 THEN nk + 1 ELSE nk END g, area FROM customers) r
       ON l.g = r.g AND l.area = r.area""",
)

# --- reconciliation ---

CTES["second"] = """
    SELECT a, e, yr, v FROM (
        SELECT k, a, e, yr, CAST(CASE WHEN k % 6 = 0 THEN CAST(v * 1.5 AS DECIMAL(18,6)) ELSE v END AS DECIMAL(18,6)) v
        FROM (SELECT k, a, e, yr, CAST(v AS DECIMAL(18,6)) v FROM leaf WHERE yr <> 1997 AND k % 10 <> 9)
        UNION ALL
        SELECT k, 'Z' || a, e, yr, CAST(CASE WHEN k % 6 = 0 THEN CAST(v * 1.5 AS DECIMAL(18,6)) ELSE v END AS DECIMAL(18,6))
        FROM (SELECT k, a, e, yr, CAST(v AS DECIMAL(18,6)) v FROM leaf WHERE yr <> 1997 AND k % 10 <> 9 AND k % 77 = 0))"""
RECON = """SELECT coalesce(f.a, l.a) a, coalesce(f.e, l.e) e, coalesce(f.yr, l.yr) yr, f.v vf, l.v vs,
       CASE WHEN f.v = l.v THEN 'ok' WHEN f.v <> l.v THEN 'no' WHEN l.v IS NOT NULL THEN 'second_only' WHEN f.v IS NOT NULL THEN 'first_only'
            ELSE '?' END c
    FROM second f FULL JOIN leaf l ON f.a = l.a AND f.e = l.e AND f.yr = l.yr"""
KEYED = 'a "geographicAreaM49", e "measuredElement", yr "timePointYears"'
oracle(
    "cube_difference",
    f"""SELECT {KEYED}, CAST(v AS DOUBLE) "Value", side FROM (
        SELECT *, 'first' side FROM (SELECT a, e, yr, CAST(v AS DECIMAL(28,6)) v FROM leaf EXCEPT SELECT a, e, yr, CAST(v AS DECIMAL(28,6)) v FROM second)
        UNION ALL SELECT *, 'second' side FROM (SELECT a, e, yr, CAST(v AS DECIMAL(28,6)) v FROM second EXCEPT SELECT a, e, yr, CAST(v AS DECIMAL(28,6)) v FROM leaf))""",
)
oracle(
    "recon_status",
    f"""SELECT {KEYED}, CAST(vf AS DOUBLE) value_first, CAST(vs AS DOUBLE) value_second, c "check",
               CASE WHEN c = 'no' THEN CAST(vs - vf AS DOUBLE) END diff FROM ({RECON})""",
)
oracle(
    "recon_match_rate",
    f"""SELECT count(*) n, count(*) FILTER (c = 'ok') n_equal, count(*) FILTER (c = 'no') n_different,
               count(*) FILTER (c = 'first_only') n_first_only, count(*) FILTER (c = 'second_only') n_second_only,
               count(*) FILTER (c = '?') n_unknown,
               CAST(count(*) FILTER (c = 'ok') AS DOUBLE) / CAST(count(*) AS DOUBLE) match_rate FROM ({RECON})""",
)
oracle(
    "recon_relative_change",
    f"""SELECT {KEYED}, CAST(v AS DOUBLE) value_first, CAST(w AS DOUBLE) value_second, CAST(v - w AS DOUBLE) difference,
               CAST(v - w AS DOUBLE) / CAST(w AS DOUBLE) "change"
        FROM (SELECT l.a, l.e, l.yr, l.v, f.v w FROM leaf l JOIN second f ON f.a = l.a AND f.e = l.e AND f.yr = l.yr)
        WHERE w <> 0 AND abs(CAST(v - w AS DOUBLE) / CAST(w AS DOUBLE)) > 0.2""",
)
oracle(
    "recon_percent_variation",
    """SELECT a "geographicAreaM49", yr "timePointYears", CAST(v AS DOUBLE) value_first, CAST(w AS DOUBLE) value_second,
              CAST(v - w AS DOUBLE) difference, CAST(v - w AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0) * 100 "percent"
       FROM (SELECT l.a, l.yr, l.v, f.v w FROM leaf l JOIN second f ON f.a = l.a AND f.e = l.e AND f.yr = l.yr
             WHERE l.e = '511')""",
)
oracle(
    "recon_paired_areas",
    """WITH x AS (SELECT l.k, l.a, l.yr, CAST(l.v - f.v AS DOUBLE) d FROM leaf l JOIN second f ON f.a = l.a AND f.e = l.e AND f.yr = l.yr WHERE l.e = '511')
       SELECT p.a "left", q.a "right", p.yr "timePointYears", p.d difference_left, q.d difference_right FROM x p JOIN x q ON q.k = p.k + 1 AND q.yr = p.yr
       WHERE p.k % 2 = 0 AND (p.k % 4 <> 0 OR p.yr >= 1996) AND (p.k % 6 <> 0 OR p.yr <= 1999)""",
)
head, tail = ORACLES["recon_paired_areas"].split(" WITH x AS ", 1)
ORACLES["recon_paired_areas"] = f"{head}, x AS {tail}"
oracle(
    "recon_threshold",
    """SELECT label, yr "timePointYears", CAST(p AS DOUBLE) value_first, CAST(c AS DOUBLE) value_second,
              CAST(p - c AS DOUBLE) difference,
              CASE WHEN p - c > 0.1 THEN 'above' WHEN p - c < -0.1 THEN 'below' ELSE 'within' END band
       FROM (SELECT r_name label, yr, sum(v) c,
                    sum(v) + CASE r_regionkey WHEN 1 THEN 0.05 WHEN 2 THEN 1 WHEN 3 THEN -1 ELSE 0 END p
             FROM full_cube JOIN nation ON nk = n_nationkey JOIN region ON n_regionkey = r_regionkey
             WHERE e = '511' GROUP BY r_name, r_regionkey, yr)""",
)
oracle(
    "recon_original",
    """SELECT coalesce(x.a, y.a) "geographicAreaM49", coalesce(x.yr, y.yr) "timePointYears", CAST(x.v AS DOUBLE) value_stored,
              CAST(y.v AS DOUBLE) value_original, x.v = y.v equal
       FROM (SELECT * FROM leaf WHERE e = '511' AND k % 14 <> 1) x
       FULL JOIN (SELECT a, yr, round(v + CASE WHEN k % 8 = 0 THEN 0.001 WHEN k % 5 = 0 THEN 0.0004 ELSE 0 END, 3) v
                  FROM leaf WHERE e = '511' AND k % 15 <> 1) y ON x.a = y.a AND x.yr = y.yr""",
)
oracle(
    "world_total_no_double",
    "SELECT count(*) n, CAST(sum(v) AS DOUBLE) total FROM leaf WHERE yr = 2000 AND e = '511'",
)
