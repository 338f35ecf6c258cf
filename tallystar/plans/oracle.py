"""DuckDB SQL for each catalog query, over the raw test tables.

The SQL recomputes the stand-in from the tables (it does not read anything
Spark wrote), so each pair checks the whole path: landing, reading, cleaning,
decoding and the query. Column names match the Spark results.
"""

from __future__ import annotations

from tallystar.operators.names import EDITS, SHARE

# what Python's str.strip() removes
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _strip(c: str) -> str:
    return f"trim({c}, '{BLANKS}')"


def _whole_int(c: str) -> str:
    """The whole text as an INTEGER, else NULL."""
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS INTEGER) END"


RAW = """
raw AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS ID,
         CASE WHEN l.l_partkey % 89 <> 3 THEN l.l_returnflag END AS Geslacht,
         CASE l.l_partkey % 97 WHEN 5 THEN CAST(10000 + 10 * p.p_size AS VARCHAR) || 'abc'
           WHEN 7 THEN '00000' || CAST(10000 + 10 * p.p_size AS VARCHAR) WHEN 11 THEN '2000000000'
           WHEN 13 THEN '-5' WHEN 17 THEN '1e5'
           ELSE CAST(10000 + 10 * p.p_size AS VARCHAR) END AS LeeftijdOp31December,
         o.o_orderpriority || '   ' AS BurgerlijkeStaat,
         CASE WHEN c.c_custkey % 83 = 1 THEN '99' ELSE CAST(c.c_nationkey AS VARCHAR) END AS Geboorteland,
         CAST(year(o.o_orderdate) AS VARCHAR) || 'JJ00' || CASE WHEN c.c_custkey % 79 = 2 THEN chr(160) ELSE '' END
           AS Perioden,
         CAST(NULLIF(CAST(l.l_quantity AS INTEGER), 50) - 1 AS INTEGER) AS Immigratie_1
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

CLEAN = f""",
trimmed AS (
  SELECT ID, {_strip('Geslacht')} AS Geslacht, {_strip('LeeftijdOp31December')} AS LeeftijdOp31December,
         {_strip('BurgerlijkeStaat')} AS BurgerlijkeStaat, {_strip('Geboorteland')} AS Geboorteland,
         {_strip('Perioden')} AS Perioden, Immigratie_1
  FROM raw),
clean AS (
  SELECT * FROM trimmed
  WHERE Immigratie_1 IS NOT NULL AND Immigratie_1 > 0
    AND {_whole_int('LeeftijdOp31December')} < 10460
    AND Geslacht IS DISTINCT FROM 'R' AND LeeftijdOp31December IS DISTINCT FROM '10000'
    AND BurgerlijkeStaat IS DISTINCT FROM '4-NOT SPECIFIED' AND Geboorteland IS DISTINCT FROM 'T001175')"""

DEDUP = """,
dedup AS (
  SELECT ID, Geslacht, LeeftijdOp31December, BurgerlijkeStaat, Geboorteland, Perioden, Immigratie_1
  FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY Geslacht NULLS LAST,
               LeeftijdOp31December NULLS LAST, BurgerlijkeStaat NULLS LAST, Geboorteland NULLS LAST,
               Perioden NULLS LAST, Immigratie_1 NULLS LAST) AS rn FROM clean)
  WHERE rn = 1)"""

GENDER_CASE = ("CASE {c} WHEN 'A' THEN 'Men' WHEN 'N' THEN 'Women' "
               "WHEN 'R' THEN 'Total men and women' END")
MARITAL_CASE = ("CASE {c} WHEN '1-URGENT' THEN 'Unmarried' WHEN '2-HIGH' THEN 'Married' "
                "WHEN '3-MEDIUM' THEN 'Remarried' WHEN '4-NOT SPECIFIED' THEN 'Total' "
                "WHEN '5-LOW' THEN 'Divorced' END")
ENGLISH = "upper(substr({n}, 1, 1)) || lower(substr({n}, 2))"

# the code lists of the stand-in; nation 13 has no translation
LISTS = """,
genders AS (SELECT DISTINCT l_returnflag AS code FROM lineitem),
ages AS (SELECT DISTINCT CAST(10000 + 10 * p_size AS VARCHAR) AS code, p_size - 1 AS age FROM part),
maritals AS (SELECT DISTINCT o_orderpriority AS code FROM orders),
periods AS (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || 'JJ00' AS code FROM orders),
translated AS (SELECT n_nationkey AS key, n.* FROM nation n JOIN region ON n_regionkey = r_regionkey
               WHERE n_nationkey <> 13)"""

FACT = LISTS + f""",
fact AS (
  SELECT d.ID,
         {GENDER_CASE.format(c='d.Geslacht')} AS Gender,
         CAST(a.age AS INTEGER) AS Age,
         {MARITAL_CASE.format(c='d.BurgerlijkeStaat')} AS MaritalStatus,
         {ENGLISH.format(n='n.n_name')} AS Country,
         d.Immigratie_1 AS ImmigrationVolume,
         CASE WHEN n.n_regionkey < 4 THEN 'Y' ELSE 'N' END AS SingleCountry,
         CAST(substr(d.Perioden, 1, 4) AS INTEGER) AS Year
  FROM dedup d
  JOIN genders g ON g.code = d.Geslacht JOIN ages a ON a.code = d.LeeftijdOp31December
  JOIN maritals m ON m.code = d.BurgerlijkeStaat JOIN periods p ON p.code = d.Perioden
  JOIN translated n ON CAST(n.key AS VARCHAR) = d.Geboorteland)"""


def _ratio(num: str, scale: str) -> str:
    return f"CAST(({num}) // g.n AS DOUBLE) / CAST({scale} AS DOUBLE)"


HAPPY = f""",
happy_agg AS (
  SELECT s.s_nationkey AS nk, CAST(year(l.l_shipdate) AS INTEGER) AS y, count(*) AS n,
         sum(CAST(round(l.l_discount * 100) AS BIGINT)) AS disc,
         sum(CAST(round(l.l_tax * 100) AS BIGINT)) AS tax,
         sum(CAST(l.l_quantity AS BIGINT)) AS qty,
         count(*) FILTER (WHERE l.l_returnflag = 'A') AS ret,
         count(*) FILTER (WHERE l.l_linestatus = 'F') AS fin,
         sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS price
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE NOT (s.s_nationkey = 9 AND year(l.l_shipdate) = 1997)
  GROUP BY 1, 2),
happy AS (
  SELECT {ENGLISH.format(n='n.n_name')} AS Country,
         {_ratio('g.disc * 100', '100')} AS Happiness_Score,
         {_ratio('g.tax * 100', '100')} AS GDP_Score,
         {_ratio('g.qty * 20', '100')} AS Health_Score,
         {_ratio('g.ret * 1000', '100')} AS Freedom_Score,
         {_ratio('g.fin * 1000', '100')} AS Generosity_Score,
         CASE WHEN NOT (g.nk % 7 = 3 AND g.y = 1998) THEN {_ratio('g.price', '1000000')} END AS Corruption_Score,
         g.y AS Year,
         r.r_name AS Region,
         {_ratio('g.tax * 50', '100')} AS Social_Score
  FROM happy_agg g JOIN nation n ON g.nk = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

W_RAW = "WITH " + RAW
W_CLEAN = W_RAW + CLEAN
W_DEDUP = W_CLEAN + DEDUP
W_FACT = W_DEDUP + FACT
W_HAPPY = "WITH " + HAPPY.lstrip(",\n")
W_STAR = W_FACT + HAPPY

DIM_COLS = ("Country, Happiness_Score, GDP_Score, Health_Score, Freedom_Score, Generosity_Score, "
            "Corruption_Score, Year")
FACT_COLS = "ID, Gender, Age, MaritalStatus, Country, ImmigrationVolume, SingleCountry, Year"
RAW_COLS = ("ID, Geslacht, LeeftijdOp31December, BurgerlijkeStaat, Geboorteland, Perioden, "
            "Immigratie_1")

AGE_TITLE = ("CASE WHEN s <= 44 THEN CAST(s - 1 AS VARCHAR) || ' jaar' "
             "WHEN s = 45 THEN CAST(s - 1 AS VARCHAR) || ' jaar of ouder' "
             "ELSE CAST((s - 46) * 5 AS VARCHAR) || ' tot ' || CAST((s - 46) * 5 + 5 AS VARCHAR) || ' jaar' END")

SQL: dict[str, str] = {
    # ---- marts
    "mart_topk_with_score": W_STAR + """
SELECT v.Country, v.sumImmigrationVolume, h.Happiness_Score
FROM (SELECT Country, CAST(sum(ImmigrationVolume) AS BIGINT) AS sumImmigrationVolume
      FROM fact WHERE Year = 1998 AND SingleCountry = 'Y' GROUP BY Country) v
JOIN happy h ON h.Country = v.Country AND h.Year = 1998
ORDER BY v.sumImmigrationVolume DESC, v.Country LIMIT 10""",
    "mart_profile": W_FACT + """
SELECT Year, Age, CAST(sum(ImmigrationVolume) AS BIGINT) AS sumImmigrationVolume
FROM fact GROUP BY Year, Age""",
    "mart_profile_split": W_FACT + """
SELECT Year, Gender, Age, CAST(sum(ImmigrationVolume) AS BIGINT) AS sumImmigrationVolume
FROM fact GROUP BY Year, Gender, Age""",
    "mart_correlation": W_STAR + """
SELECT v.Year, round(corr(log10(v.vol), h.Happiness_Score), 6) AS corr_log_volume_score,
       count(*) AS n_countries
FROM (SELECT Country, Year, sum(ImmigrationVolume) AS vol FROM fact
      WHERE SingleCountry = 'Y' GROUP BY Country, Year) v
JOIN happy h ON h.Country = v.Country AND h.Year = v.Year
GROUP BY v.Year""",
    "mart_trend_pivot": W_FACT + """
SELECT Age, """ + ", ".join(
        f"CAST(sum(ImmigrationVolume) FILTER (WHERE Year = {y}) AS BIGINT) AS y{y}"
        for y in range(1995, 2002)) + """
FROM fact GROUP BY Age""",
    "mart_topk_per_year": W_STAR + """
SELECT Year, rank, Country, sumImmigrationVolume, Happiness_Score FROM (
  SELECT v.Year, v.Country, v.sumImmigrationVolume, h.Happiness_Score,
         CAST(row_number() OVER (PARTITION BY v.Year ORDER BY v.sumImmigrationVolume DESC, v.Country)
              AS INTEGER) AS rank
  FROM (SELECT Year, Country, CAST(sum(ImmigrationVolume) AS BIGINT) AS sumImmigrationVolume
        FROM fact WHERE SingleCountry = 'Y' GROUP BY Year, Country) v
  JOIN happy h ON h.Country = v.Country AND h.Year = v.Year)
WHERE rank <= 10""",
    "mart_trend_country": W_FACT + """
SELECT Country, """ + ", ".join(
        f"CAST(sum(ImmigrationVolume) FILTER (WHERE Year = {y}) AS BIGINT) AS y{y}"
        for y in range(1995, 2002)) + """
FROM fact GROUP BY Country""",
    "mart_trend_gender": W_FACT + """
SELECT Gender, """ + ", ".join(
        f"CAST(sum(ImmigrationVolume) FILTER (WHERE Year = {y}) AS BIGINT) AS y{y}"
        for y in range(1995, 2002)) + """
FROM fact GROUP BY Gender""",
    "fact_build": W_FACT + f"\nSELECT {FACT_COLS} FROM fact",
    "dimension_build": W_HAPPY + f"\nSELECT {DIM_COLS} FROM happy",
    # ---- aggregates
    "agg_sum_by_key": W_FACT + """
SELECT Country, CAST(sum(ImmigrationVolume) AS BIGINT) AS sumImmigrationVolume FROM fact GROUP BY Country""",
    "agg_row_counts": W_FACT + """
SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'fact', count(*) FROM fact""",
    "agg_dedup": W_DEDUP + f"\nSELECT {RAW_COLS} FROM dedup",
    "win_rank": W_HAPPY + """
SELECT Country, Year, Happiness_Score,
       CAST(row_number() OVER (PARTITION BY Year ORDER BY Happiness_Score DESC, Country) AS INTEGER)
         AS Overall_rank
FROM happy""",
    "topk": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    # ---- filters
    "filt_measure": W_RAW + f"\nSELECT {RAW_COLS} FROM raw WHERE Immigratie_1 IS NOT NULL AND Immigratie_1 > 0",
    "filt_code_range": W_RAW + f"""
SELECT {RAW_COLS} FROM raw
WHERE {_whole_int('LeeftijdOp31December')} < 10460""",
    "filt_drop_totals": W_RAW + f"""
SELECT ID, {_strip('Geslacht')} AS Geslacht, {_strip('LeeftijdOp31December')} AS LeeftijdOp31December,
       {_strip('BurgerlijkeStaat')} AS BurgerlijkeStaat, {_strip('Geboorteland')} AS Geboorteland,
       Perioden, Immigratie_1
FROM raw
WHERE {_strip('Geslacht')} IS DISTINCT FROM 'R'
  AND {_strip('LeeftijdOp31December')} IS DISTINCT FROM '10000'
  AND {_strip('BurgerlijkeStaat')} IS DISTINCT FROM '4-NOT SPECIFIED'
  AND {_strip('Geboorteland')} IS DISTINCT FROM 'T001175'""",
    "filt_conjunction": W_FACT + f"\nSELECT {FACT_COLS} FROM fact WHERE Year = 1998 AND SingleCountry = 'Y'",
    "filt_partition": W_FACT + f"\nSELECT {FACT_COLS} FROM fact WHERE Year = 1998",
    "filt_key_slice": """
SELECT o_orderkey, o_custkey, o_orderpriority, key_kind
FROM orders, (VALUES ('number'), ('text')) AS kinds(key_kind)
WHERE (o_orderkey BETWEEN 100 AND 104 OR o_orderkey BETWEEN 300 AND 304 OR o_orderkey BETWEEN 400 AND 404)""",
    "map_lookup": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "json_map_explode": """
SELECT e.event_id, CAST(len(json_keys(e.props)) AS INTEGER) AS n_keys, t.key,
       CAST(json_extract(e.props, '$."' || t.key || '"') AS INTEGER) AS value
FROM events e, unnest(json_keys(e.props)) AS t(key)""",
    # ---- joins
    "join_star_decode": W_CLEAN + LISTS + f"""
SELECT d.ID, {GENDER_CASE.format(c='d.Geslacht')} AS Gender, CAST(a.age AS INTEGER) AS Age,
       {MARITAL_CASE.format(c='d.BurgerlijkeStaat')} AS MaritalStatus,
       n.n_name AS Land, CAST(substr(d.Perioden, 1, 4) AS INTEGER) AS Year, d.Immigratie_1
FROM clean d JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = d.Geboorteland
JOIN genders g ON g.code = d.Geslacht JOIN ages a ON a.code = d.LeeftijdOp31December
JOIN maritals m ON m.code = d.BurgerlijkeStaat JOIN periods p ON p.code = d.Perioden""",
    "join_two_hop": W_RAW + LISTS + f"""
SELECT r.ID, {_strip('r.Geboorteland')} AS Geboorteland, n.n_name AS Land,
       {ENGLISH.format(n='n.n_name')} AS Country,
       CASE WHEN n.n_regionkey < 4 THEN 'Y' ELSE 'N' END AS SingleCountry
FROM raw r JOIN translated n ON CAST(n.key AS VARCHAR) = {_strip('r.Geboorteland')}""",
    "join_coverage_anti": """
SELECT DISTINCT o.o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "join_coverage_codes": W_CLEAN + """,
codes AS (
  SELECT 'gender' AS dimension, Geslacht AS code FROM clean
  UNION ALL SELECT 'age', LeeftijdOp31December FROM clean
  UNION ALL SELECT 'marital', BurgerlijkeStaat FROM clean
  UNION ALL SELECT 'country', Geboorteland FROM clean
  UNION ALL SELECT 'period', Perioden FROM clean),
known AS (
  SELECT 'gender' AS dimension, l_returnflag AS code FROM lineitem
  UNION SELECT 'age', CAST(10000 + 10 * p_size AS VARCHAR) FROM part
  UNION SELECT 'age', '10000'
  UNION SELECT 'marital', o_orderpriority FROM orders
  UNION SELECT 'country', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION SELECT 'period', CAST(year(o_orderdate) AS VARCHAR) || 'JJ00' FROM orders)
SELECT c.dimension, c.code, count(*) AS rows FROM codes c
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.dimension = c.dimension AND k.code = c.code)
GROUP BY c.dimension, c.code
UNION ALL
SELECT 'translation', n.n_name, count(*) FROM clean d JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = d.Geboorteland
WHERE n.n_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey <> 13)
GROUP BY n.n_name""",
    "join_coverage_scores": W_STAR + """
SELECT DISTINCT f.Country, f.Year FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM happy h WHERE h.Country = f.Country AND h.Year = f.Year)""",
    "join_rename_suggestions": W_HAPPY + f""",
spelled AS (
  SELECT side, name, trim(regexp_replace(lower(replace(name, '&', ' and ')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS plain FROM (
    SELECT DISTINCT 'a' AS side, Country AS name FROM happy
    UNION ALL SELECT DISTINCT 'b', n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 13)),
named AS (SELECT *, list_distinct(string_split(plain, ' ')) AS words FROM spelled WHERE plain <> ''),
counted AS (SELECT *, list_sum(list_transform(words, lambda w: length(w))) AS letters FROM named),
pairs AS (
  SELECT a.name, b.name AS suggestion, levenshtein(a.plain, b.plain) AS edits, greatest(length(a.plain), length(b.plain)) AS longer,
         coalesce(list_sum(list_transform(list_intersect(a.words, b.words), lambda w: length(w))), 0) * 1000
           // least(a.letters, b.letters) AS common
  FROM counted a JOIN counted b ON a.side = 'a' AND b.side = 'b'
  WHERE a.name NOT IN (SELECT name FROM counted WHERE side = 'b')),
scored AS (SELECT *, greatest(common, (longer - edits) * 1000 // longer) AS score FROM pairs WHERE common >= {SHARE} OR edits <= {EDITS}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, edits, suggestion) AS rank FROM scored)
SELECT name, CAST(rank AS INT) AS rank, suggestion, CAST(score AS INT) AS score, CAST(edits AS INT) AS edits FROM ranked WHERE rank <= 3""",
    # ---- profiles
    "profile_nulls": W_RAW + """
SELECT * FROM (VALUES
  ('ID', 'string', (SELECT count(ID) FROM raw), (SELECT count(*) FILTER (WHERE ID IS NULL) FROM raw)),
  ('Geslacht', 'string', (SELECT count(Geslacht) FROM raw), (SELECT count(*) FILTER (WHERE Geslacht IS NULL) FROM raw)),
  ('LeeftijdOp31December', 'string', (SELECT count(LeeftijdOp31December) FROM raw),
     (SELECT count(*) FILTER (WHERE LeeftijdOp31December IS NULL) FROM raw)),
  ('BurgerlijkeStaat', 'string', (SELECT count(BurgerlijkeStaat) FROM raw),
     (SELECT count(*) FILTER (WHERE BurgerlijkeStaat IS NULL) FROM raw)),
  ('Geboorteland', 'string', (SELECT count(Geboorteland) FROM raw),
     (SELECT count(*) FILTER (WHERE Geboorteland IS NULL) FROM raw)),
  ('Perioden', 'string', (SELECT count(Perioden) FROM raw), (SELECT count(*) FILTER (WHERE Perioden IS NULL) FROM raw)),
  ('Immigratie_1', 'int', (SELECT count(Immigratie_1) FROM raw),
     (SELECT count(*) FILTER (WHERE Immigratie_1 IS NULL) FROM raw))
) AS t(column_name, data_type, non_null, nulls)""",
    "profile_distinct": "SELECT * FROM (VALUES " + ", ".join(
        f"('{c}', (SELECT count(DISTINCT {c}) FROM lineitem))"
        for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"]
    ) + ") AS t(column_name, n_distinct)",
    "profile_distinct_sketched": W_FACT + "\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct FROM fact"
        for c in ["Gender", "Age", "MaritalStatus", "Country", "SingleCountry"]),
    "profile_distinct_values": W_FACT + "\nSELECT DISTINCT Country FROM fact ORDER BY Country",
    "profile_describe": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in ["l_quantity", "l_discount", "l_tax"]),
    "profile_describe_distinct": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       min(v) AS min, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
       round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max FROM (SELECT {e} AS v FROM lineitem)"""
        for c, e in [("price_per_key", "l_extendedprice / (l_orderkey * 8 + l_linenumber)"),
                     ("part_per_price", "l_partkey / l_extendedprice")]),
    "profile_describe_dim": W_HAPPY + "\n" + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM happy"""
        for c in ["Happiness_Score", "GDP_Score", "Health_Score", "Freedom_Score", "Generosity_Score",
                  "Corruption_Score"]),
    "profile_nulls_dim": W_HAPPY + "\nSELECT * FROM (VALUES " + ", ".join(
        f"('{c}', '{t}', (SELECT count({c}) FROM happy), (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM happy))"
        for c, t in [("Country", "string"), ("Happiness_Score", "double"), ("GDP_Score", "double"),
                     ("Health_Score", "double"), ("Freedom_Score", "double"), ("Generosity_Score", "double"),
                     ("Corruption_Score", "double"), ("Year", "int")]) + ") AS t(column_name, data_type, non_null, nulls)",
    "head_tail": """
SELECT * FROM (SELECT 'head' AS side, p_partkey, p_type, p_size FROM part ORDER BY p_partkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'tail' AS side, p_partkey, p_type, p_size FROM part ORDER BY p_partkey DESC LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'cell' AS side, p_partkey, p_type, p_size FROM part ORDER BY p_partkey LIMIT 1 OFFSET 1)""",
    "sample_rows_by_key": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1000""",
    "sample_n": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8), o_orderkey LIMIT 10""",
    "set_difference_both": """
SELECT o_custkey, 'only_1998' AS side FROM (
  SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998
  EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999)
UNION ALL
SELECT o_custkey, 'only_1999' AS side FROM (
  SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999
  EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998)""",
    "set_except": """
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998
EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999""",
    # ---- quality
    "dq_report": W_FACT + """
SELECT * FROM (VALUES
  ('not_empty', (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM fact)),
  ('no_null_cells', (SELECT count(*) FILTER (WHERE ID IS NULL) + count(*) FILTER (WHERE Gender IS NULL)
     + count(*) FILTER (WHERE Age IS NULL) + count(*) FILTER (WHERE MaritalStatus IS NULL)
     + count(*) FILTER (WHERE Country IS NULL) + count(*) FILTER (WHERE ImmigrationVolume IS NULL)
     + count(*) FILTER (WHERE SingleCountry IS NULL) + count(*) FILTER (WHERE Year IS NULL) FROM fact)),
  ('no_zero_measure', (SELECT count(*) FILTER (WHERE ImmigrationVolume = 0) FROM fact))
) AS t(check_name, failures)""".replace("SELECT * FROM (VALUES", "SELECT *, CASE WHEN failures = 0 THEN 'passed' ELSE 'failed' END AS status FROM (VALUES"),
    "dq_duplicates": W_RAW + """
SELECT count(*) AS rows, count(DISTINCT ID) AS distinct_keys, count(*) - count(DISTINCT ID) AS duplicates
FROM raw""",
    "dq_domain": W_FACT + """
SELECT *, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status FROM (VALUES
  ('gender_known', (SELECT count(*) FILTER (WHERE NOT coalesce(Gender IN ('Men', 'Women'), false)) FROM fact)),
  ('age_0_105', (SELECT count(*) FILTER (WHERE NOT coalesce(Age BETWEEN 0 AND 105, false)) FROM fact)),
  ('volume_positive', (SELECT count(*) FILTER (WHERE NOT coalesce(ImmigrationVolume > 0, false)) FROM fact)),
  ('flag_y_n', (SELECT count(*) FILTER (WHERE NOT coalesce(SingleCountry IN ('Y', 'N'), false)) FROM fact))
) AS t(rule, violations)""",
    "dq_domain_dim": W_HAPPY + "\nSELECT *, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status "
    "FROM (VALUES " + ", ".join(
        f"('{c}_0_10', (SELECT count(*) FILTER (WHERE NOT coalesce({c} BETWEEN 0 AND 10, false)) FROM happy))"
        for c in ["Happiness_Score", "GDP_Score", "Health_Score", "Freedom_Score", "Generosity_Score",
                  "Corruption_Score"]) + ") AS t(rule, violations)",
    "dq_reconcile": W_HAPPY + """,
merged AS (
  SELECT DISTINCT CASE WHEN Country IN ('Nation_20', 'Nation_21', 'Nation_22', 'Nation_23', 'Nation_24')
                       THEN 'Nation_' || CAST(CAST(substr(Country, 8) AS INTEGER) - 20 AS VARCHAR)
                       ELSE Country END AS Country, Year FROM happy)
SELECT *, CASE WHEN rows_in = rows_out THEN 'passed' ELSE 'failed' END AS status
FROM (SELECT Year, count(*) AS rows_in FROM happy GROUP BY Year)
JOIN (SELECT Year, count(*) AS rows_out FROM merged GROUP BY Year) USING (Year)""",
    "dq_rejects": W_DEDUP + LISTS + f""",
flagged AS (
  SELECT CASE WHEN Immigratie_1 IS NULL THEN 'measure_missing' WHEN Immigratie_1 <= 0 THEN 'measure_not_positive'
              WHEN ({_whole_int('LeeftijdOp31December')}) IS NULL THEN 'age_code_unusable'
              WHEN {_whole_int('LeeftijdOp31December')} >= 10460 THEN 'age_band'
              WHEN Geslacht = 'R' THEN 'total_Geslacht' WHEN LeeftijdOp31December = '10000' THEN 'total_LeeftijdOp31December'
              WHEN BurgerlijkeStaat = '4-NOT SPECIFIED' THEN 'total_BurgerlijkeStaat'
              WHEN Geboorteland = 'T001175' THEN 'total_Geboorteland' END AS step FROM trimmed),
decoded AS (
  SELECT CASE WHEN g.code IS NULL THEN 'decode_gender' WHEN a.code IS NULL THEN 'decode_age'
              WHEN m.code IS NULL THEN 'decode_marital' WHEN n.n_nationkey IS NULL THEN 'decode_country'
              WHEN p.code IS NULL THEN 'decode_period' WHEN t.key IS NULL THEN 'decode_translation'
              ELSE 'rows_out' END AS step
  FROM dedup d LEFT JOIN genders g ON g.code = d.Geslacht LEFT JOIN ages a ON a.code = d.LeeftijdOp31December
  LEFT JOIN maritals m ON m.code = d.BurgerlijkeStaat LEFT JOIN periods p ON p.code = d.Perioden
  LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = d.Geboorteland
  LEFT JOIN translated t ON t.key = n.n_nationkey)
SELECT step, CAST(n AS BIGINT) AS rows FROM (
  SELECT 'rows_in' AS step, count(*) AS n FROM raw
  UNION ALL SELECT step, count(*) FROM flagged WHERE step IS NOT NULL GROUP BY step
  UNION ALL SELECT 'duplicates', (SELECT count(*) FROM clean) - (SELECT count(*) FROM dedup)
  UNION ALL SELECT step, count(*) FROM decoded GROUP BY step) WHERE n <> 0""",
    "dq_schema": W_FACT + """
SELECT column_name, expected_type, data_type, nulls,
       CASE WHEN expected_type = data_type AND nulls = 0 THEN 'passed' ELSE 'failed' END AS status
FROM (VALUES
  ('ID', 'string', 'string', (SELECT count(*) FILTER (WHERE ID IS NULL) FROM fact)),
  ('Gender', 'string', 'string', (SELECT count(*) FILTER (WHERE Gender IS NULL) FROM fact)),
  ('Age', 'int', 'int', (SELECT count(*) FILTER (WHERE Age IS NULL) FROM fact)),
  ('MaritalStatus', 'string', 'string', (SELECT count(*) FILTER (WHERE MaritalStatus IS NULL) FROM fact)),
  ('Country', 'string', 'string', (SELECT count(*) FILTER (WHERE Country IS NULL) FROM fact)),
  ('ImmigrationVolume', 'int', 'int', (SELECT count(*) FILTER (WHERE ImmigrationVolume IS NULL) FROM fact)),
  ('SingleCountry', 'string', 'string', (SELECT count(*) FILTER (WHERE SingleCountry IS NULL) FROM fact)),
  ('Year', 'int', 'int', (SELECT count(*) FILTER (WHERE Year IS NULL) FROM fact))
) AS t(column_name, expected_type, data_type, nulls)""",
    "dq_key_unique": W_HAPPY + """
SELECT Country, Year, count(*) AS n
FROM (SELECT CASE WHEN Country IN ('Nation_20', 'Nation_21', 'Nation_22', 'Nation_23', 'Nation_24')
                  THEN 'Nation_' || CAST(CAST(substr(Country, 8) AS INTEGER) - 20 AS VARCHAR)
                  ELSE Country END AS Country, Year FROM happy)
GROUP BY Country, Year HAVING count(*) > 1""",
    # ---- strings / scalars
    "str_trim_replace": f"""
SELECT doc_id,
  regexp_replace(regexp_replace({_strip("regexp_replace(regexp_replace(text, 'Totaal', 'Total', 'g'), 'jaar', '', 'g')")},
    'of ouder', 'or older', 'g'), 'tot', 'to', 'g') AS text_clean
FROM documents""",
    "str_harmonise": W_HAPPY + """
SELECT Country, Year, round(avg(Happiness_Score), 6) AS Happiness_Score, count(*) AS n_merged
FROM (SELECT CASE WHEN Country IN ('Nation_20', 'Nation_21', 'Nation_22', 'Nation_23', 'Nation_24')
                  THEN 'Nation_' || CAST(CAST(substr(Country, 8) AS INTEGER) - 20 AS VARCHAR)
                  ELSE Country END AS Country, Year, Happiness_Score FROM happy)
GROUP BY Country, Year""",
    "proj_select_rename": W_RAW + """
SELECT ID, Geslacht AS GenderCode, LeeftijdOp31December AS AgeCode, BurgerlijkeStaat AS MaritalCode,
       Geboorteland AS CountryCode, Perioden AS PeriodCode, Immigratie_1 AS ImmigrationVolume FROM raw""",
    "proj_constant": "SELECT p_partkey, p_size, 2018 AS Year FROM part",
    "proj_decode_map": W_RAW + f"""
SELECT ID, Geslacht, {GENDER_CASE.format(c='Geslacht')} AS Gender,
       {MARITAL_CASE.format(c=_strip('BurgerlijkeStaat'))} AS MaritalStatus FROM raw""",
    "proj_safe_cast": f"""
SELECT l_orderkey, l_linenumber, qty_text, {_whole_int('qty_text')} AS qty_direct,
       TRY_CAST(trunc(TRY_CAST(trim(qty_text) AS DOUBLE)) AS INTEGER) AS qty_int
FROM (SELECT l_orderkey, l_linenumber, CASE l_partkey % 11 WHEN 0 THEN '2000000000' WHEN 1 THEN '-7'
        WHEN 2 THEN '0000000000042' WHEN 3 THEN '3000000000' WHEN 4 THEN 'x1' WHEN 5 THEN ' 12 ' WHEN 6 THEN '12.9'
        ELSE CAST(l_quantity AS VARCHAR) END AS qty_text FROM lineitem)""",
    # ---- sources / sinks
    "src_year_from_path": W_RAW + """
SELECT CAST(substr(Perioden, 1, 4) AS INTEGER) AS Year, count(*) AS n_records FROM raw GROUP BY 1""",
    "src_keyed_json": W_RAW + f"\nSELECT {RAW_COLS} FROM raw",
    "src_keyed_json_ranges": W_RAW + f"\nSELECT {RAW_COLS} FROM raw",
    "src_sectioned": f"""
SELECT 0 AS section, Key, {GENDER_CASE.replace("'Men'", "'Mannen'").replace("'Women'", "'Vrouwen'")
                           .replace("'Total men and women'", "'Totaal mannen en vrouwen'").format(c='Key')} AS Title
FROM (SELECT DISTINCT l_returnflag AS Key FROM lineitem)
UNION ALL SELECT 1, '10000', 'Totaal leeftijd'
UNION ALL SELECT 1, CAST(10000 + 10 * s AS VARCHAR), {AGE_TITLE} FROM (SELECT DISTINCT p_size AS s FROM part)
UNION ALL SELECT 2, k || '   ', CASE k WHEN '1-URGENT' THEN 'Ongehuwd' WHEN '2-HIGH' THEN 'Gehuwd'
    WHEN '3-MEDIUM' THEN 'Verweduwd' WHEN '4-NOT SPECIFIED' THEN 'Totaal burgerlijke staat'
    WHEN '5-LOW' THEN 'Gescheiden' END FROM (SELECT DISTINCT o_orderpriority AS k FROM orders)
UNION ALL SELECT 3, CAST(n_nationkey AS VARCHAR), n_name FROM nation
UNION ALL SELECT 4, y || 'JJ00', y FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders)""",
    "src_csv_typed": W_HAPPY + f"""
SELECT {DIM_COLS}, CASE WHEN Year < 2000 THEN '2018' ELSE '2020' END AS layout FROM happy""",
    "src_csv_strings": f"""
SELECT n.n_name AS Land_Dutch, {ENGLISH.format(n='n.n_name')} AS Country,
       CASE WHEN n.n_regionkey < 4 THEN 'Y' ELSE 'N' END AS SingleCountry
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey <> 13""",
    "conform_union": W_HAPPY + f"\nSELECT {DIM_COLS} FROM happy",
    "scan_parquet_partitioned": W_FACT + f"\nSELECT {FACT_COLS} FROM fact",
    "sink_csv_roundtrip": W_HAPPY + f"\nSELECT {DIM_COLS} FROM happy",
    "sink_parquet_roundtrip": W_FACT + f"\nSELECT {FACT_COLS} FROM fact",
    "sink_dynamic_overwrite": W_HAPPY + f"""
SELECT {DIM_COLS.replace('Happiness_Score', 'CASE WHEN Year = 1998 THEN Happiness_Score + 1 ELSE Happiness_Score END AS Happiness_Score')}
FROM happy""",
    "stream_yearly_refresh": W_HAPPY + f"\nSELECT {DIM_COLS} FROM happy",
}
