"""DuckDB statements computing the same result as each stand-in query.

Written independently of the Spark plans (global forms, correlated
subqueries, plain CASE), so agreement is evidence rather than tautology.
Column names and types are aligned with the Spark results.
"""

from __future__ import annotations

_FY = """
  CAST(year({c}) AS INTEGER) AS fy_jan_dec,
  CAST(CASE WHEN month({c}) >= 3 THEN year({c}) ELSE year({c}) - 1 END AS INTEGER) AS fy_mar_feb,
  CAST(CASE WHEN month({c}) >= 5 THEN year({c}) ELSE year({c}) - 1 END AS INTEGER) AS fy_may_apr,
  CAST(CASE WHEN month({c}) >= 11 THEN year({c}) ELSE year({c}) - 1 END AS INTEGER) AS fy_nov_oct"""

_CATCH = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
         CASE WHEN l_suppkey = 0 THEN NULL WHEN l_suppkey = 99 THEN CAST(99998 AS BIGINT) ELSE l_suppkey END AS dealer_num,
         CASE WHEN l_linenumber = 1 THEN 'NC' ELSE CAST(l_partkey AS VARCHAR) END AS species_id
  FROM lineitem"""

_MID_DOCS = """
  SELECT o_custkey AS permit, o_orderdate AS date_sail, o_orderdate + INTERVAL 60 DAY AS date_land, o_orderkey AS docid
  FROM orders WHERE o_orderstatus = 'F'"""

SQL = {
    "trip_prep": f"""
SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'AMS' AS source_data,
  o_orderkey AS trip_id, o_custkey AS permit_nbr, o_orderpriority AS activity_code,
  CASE substr(o_orderpriority, 1, 3) WHEN '1-U' THEN 'SCALLOP' WHEN '2-H' THEN 'MONKFISH'
       WHEN '3-M' THEN 'MID-ATLANTIC' WHEN '4-N' THEN 'HERRING' END AS rsa_program,
  o_orderdate AS date_land, {_FY.format(c='o_orderdate')},
  upper(strftime(o_orderdate, '%d-%b-%y %H:%M:%S')) AS date_time_land
FROM orders
WHERE (substr(o_orderpriority, 3, 3) = 'URG' AND o_orderdate >= TIMESTAMP '1999-08-02')
   OR (substr(o_orderpriority, 13, 1) = 'I' AND o_orderdate >= TIMESTAMP '1999-08-02')
""",
    "qualify_or_exists": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_shipdate
FROM lineitem
WHERE (l_orderkey IN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') AND l_shipdate >= TIMESTAMP '1999-08-02')
   OR (l_partkey IN (SELECT DISTINCT p_partkey FROM part WHERE p_type = 'PROMO') AND l_shipdate >= TIMESTAMP '1999-08-02')
   OR (l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1999-08-02')
""",
    "report_chain": """
SELECT a.c_custkey, a.c_name, b.o_orderkey, b.o_orderstatus, b.o_orderdate,
       c.l_linenumber, c.l_partkey, c.l_suppkey, c.l_quantity
FROM customer a
LEFT JOIN orders b ON a.c_custkey = b.o_custkey
LEFT JOIN lineitem c ON b.o_orderkey = c.l_orderkey
WHERE b.o_orderstatus <> 'P'
""",
    "previous_project": """
WITH base AS (
  SELECT event_id,
         CASE WHEN user_id % 10 <> 9 THEN CAST(user_id AS VARCHAR) END AS permit,
         CASE WHEN event_id % 13 <> 0 THEN event_id END AS landing_id,
         event_type, ts
  FROM events)
SELECT event_id, permit, landing_id, event_type,
       CASE WHEN LAG(permit, 1) OVER w = permit THEN LAG(event_type, 1) OVER w END AS previous_event_type
FROM base
WINDOW w AS (ORDER BY permit ASC NULLS LAST, landing_id ASC NULLS LAST, ts ASC, event_id ASC)
""",
    "hail_union": """
SELECT 'VMS END HAIL' AS source_data, event_id AS rsa_efp_hail_id, CAST(user_id AS VARCHAR) AS vessel_permit_number,
       ts AS time_sent, upper(event_type) AS form_type, value AS species_kept, props AS activity_code
FROM events WHERE event_type = 'purchase'
UNION ALL BY NAME
SELECT 'VMS_START' AS source_data, event_id AS rsa_efp_hail_id, CAST(user_id AS VARCHAR) AS vessel_permit_number,
       ts AS time_sent, 'SAIL' AS form_type
FROM events WHERE event_type = 'signup'
""",
    "trip_id_provenance": """
WITH b AS (
  SELECT event_id, user_id,
         CASE WHEN user_id % 3 = 0 THEN CAST(user_id AS DECIMAL(38,0)) END AS docid,
         substr(props, 7, length(props) - 7) AS serial
  FROM events),
c AS (SELECT *, CASE WHEN NOT regexp_matches(serial, '[.][0-9]*[1-9]|[eE]-') THEN TRY_CAST(trim(serial) AS DECIMAL(38,0)) END AS number FROM b)
SELECT event_id, user_id, docid, serial,
  CASE WHEN docid IS NOT NULL THEN docid
       WHEN regexp_matches(serial, '[0-9]') AND number <> 0
            THEN number
       ELSE CAST(event_id AS DECIMAL(38,0)) END AS rtl_trip_id,
  CASE WHEN docid IS NOT NULL THEN 'DOCID'
       WHEN regexp_matches(serial, '[0-9]') AND number <> 0
            THEN 'VTRSERNO'
       ELSE 'RSA_TRIPID' END AS rtl_trip_id_source
FROM c
""",
    "dealer_trip_id": """
WITH b AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_orderkey % 3 <> 1 THEN CAST(l_orderkey AS DECIMAL(38,0)) END AS docid,
         CASE l_linenumber WHEN 1 THEN '0' WHEN 6 THEN '12.5' WHEN 2 THEN ' 77 ' WHEN 3 THEN 'ABC' WHEN 4 THEN NULL
              ELSE CAST(l_partkey AS VARCHAR) END AS serial,
         CAST(l_orderkey + 12345678901234 AS VARCHAR) AS dealer_rpt_id,
         CASE WHEN l_suppkey % 7 <> 0 THEN CAST(l_suppkey + 330000 AS VARCHAR) END AS permit
  FROM lineitem),
c AS (SELECT *, CASE WHEN NOT regexp_matches(serial, '[.][0-9]*[1-9]|[eE]-') THEN TRY_CAST(trim(serial) AS DECIMAL(38,0)) END AS number FROM b)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, docid, serial,
  CASE WHEN docid IS NOT NULL THEN docid
       WHEN number IS NOT NULL THEN number
       ELSE TRY_CAST(concat(dealer_rpt_id, permit) AS DECIMAL(38,0)) END AS rtl_trip_id,
  CASE WHEN docid IS NOT NULL THEN 'DOCID'
       WHEN number IS NOT NULL THEN 'VTRSERNO'
       ELSE 'DEALER_RPT_ID-PERMIT' END AS rtl_trip_id_source
FROM c
""",
    "midpoint_lookup": f"""
WITH r AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, o.o_custkey,
         o.o_orderdate + (l.l_shipdate - o.o_orderdate) / 2 AS mid
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
d AS ({_MID_DOCS})
SELECT r.*, (SELECT max(d.docid) FROM d WHERE d.permit = r.o_custkey AND r.mid BETWEEN d.date_sail AND d.date_land) AS docid
FROM r
""",
    "valid_code_list": """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate,
  coalesce((SELECT string_agg(DISTINCT v.o_orderpriority, ',' ORDER BY v.o_orderpriority)
            FROM orders v
            WHERE v.o_orderstatus = 'O' AND v.o_custkey = o.o_custkey
              AND o.o_orderdate >= v.o_orderdate AND o.o_orderdate < v.o_orderdate + INTERVAL 365 DAY), '') AS code_list
FROM orders o
""",
    "rollup_key": """
WITH b AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END AS docid,
         CAST(l_suppkey AS VARCHAR) AS permit,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS VARCHAR) END AS serial,
         lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS species_itis
  FROM lineitem),
k AS (
  SELECT *, CASE WHEN l_partkey IN (SELECT DISTINCT p_partkey FROM part WHERE p_type LIKE 'PROMO%') THEN '564'
                 ELSE substr(nullif(ltrim(species_itis, '0'), ''), 1, 3) END AS itis3
  FROM b)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || coalesce(permit, '') || '-' || coalesce(itis3, '') AS docid_permit_sppitis3_to_match,
  coalesce(serial, '0') || '-' || coalesce(permit, '') || '-' || coalesce(itis3, '') AS vtr_permit_sppitis3_to_match
FROM k
""",
    "purge_and_age": """
WITH e AS (SELECT event_id, CASE WHEN user_id % 10 <> 9 THEN CAST(user_id AS VARCHAR) END AS permit, ts FROM events)
SELECT event_id, permit, ts,
       CAST(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts) AS DOUBLE) / CAST(86400000000 AS DOUBLE) AS trip_age_in_days
FROM e
WHERE NOT coalesce(permit IN ('11', '55', '88'), false)
""",
    "disposition": f"""
WITH c AS ({_CATCH})
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, dealer_num, species_id,
  CASE WHEN dealer_num IN (1, 2, 4, 5, 7, 8, 99998) THEN 'NON-DEALER' ELSE 'DEALER' END AS dealer_type,
  CASE WHEN species_id = 'NC' AND dealer_num IS NULL THEN 'NO CATCH REPORTED'
       WHEN dealer_num = 1 THEN 'SEIZED' WHEN dealer_num = 2 THEN 'BAIT' WHEN dealer_num = 3 THEN '?'
       WHEN dealer_num = 4 THEN 'RETAINED FOR FUTURE SALE' WHEN dealer_num = 5 THEN 'SOLD TO NON-FEDERAL DEALER'
       WHEN dealer_num = 7 THEN 'LANDED FOR RESEARCH' WHEN dealer_num = 8 THEN 'LUMF, LEGAL SIZE UNMARKETABLE FISH'
       WHEN dealer_num = 99998 THEN 'HOME CONSUMPTION'
       ELSE 'SOLD TO FEDERAL DEALER' END AS disposition_of_catch
FROM c
""",
    "logbook_chain": """
SELECT d.o_orderkey, d.o_custkey, d.o_orderdate, i.l_linenumber, i.l_partkey,
       i.l_quantity AS landed_pounds, i.l_quantity * c.p_retailprice AS live_pounds
FROM orders d, lineitem i, part c
WHERE d.o_custkey IS NOT NULL
  AND d.o_orderkey = i.l_orderkey
  AND i.l_partkey = c.p_partkey
  AND d.o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND d.o_orderdate >= TIMESTAMP '1999-08-02'
""",
    "trip_set_minus": """
SELECT o_orderkey AS docid, 'VESSEL' AS source FROM orders WHERE o_orderstatus = 'F'
EXCEPT
SELECT l_orderkey AS docid, 'AMS_RSA' AS source FROM lineitem
""",
    "trip_docid_union": """
SELECT o_orderkey AS trip_id, o_custkey AS docid, 0 AS vtrserno FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT DISTINCT l_orderkey AS trip_id, l_suppkey AS docid, l_linenumber AS vtrserno FROM lineitem
""",
    "unreported_trips": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""",
    "match_keys": """
WITH j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
         CASE WHEN l.l_orderkey % 7 <> 0 THEN l.l_orderkey END AS docid,
         CASE WHEN l.l_suppkey % 7 <> 0 THEN l.l_suppkey END AS dnum,
         CASE WHEN o.o_custkey % 7 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS permit,
         CASE WHEN l.l_partkey % 7 <> 0 THEN lpad(CAST(l.l_partkey % 1000 AS VARCHAR), 3, '0') END AS nespp3,
         CASE WHEN l.l_partkey % 7 <> 1 THEN lpad(CAST(l.l_partkey AS VARCHAR), 8, '0') END AS species_itis,
         CASE WHEN l.l_linenumber <> 7 THEN CAST(l.l_linenumber AS VARCHAR) END AS vtrserno
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
k AS (SELECT *, nullif(ltrim(species_itis, '0'), '') AS itis FROM j)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || coalesce(CAST(dnum AS VARCHAR), '0') || '-' || coalesce(permit, '') || '-' || coalesce(nespp3, '') AS docid_dnum_permit_spp_to_match,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || coalesce(permit, '') || '-' || coalesce(nespp3, '') AS docid_permit_spp_to_match,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || coalesce(permit, '') || '-' || coalesce(itis, '') AS docid_permit_sppitis_to_match,
  coalesce(vtrserno, '0') || '-' || coalesce(permit, '') || '-' || coalesce(nespp3, '') AS vtr_permit_spp_to_match,
  coalesce(vtrserno, '0') || '-' || coalesce(permit, '') || '-' || coalesce(itis, '') AS vtr_permit_sppitis_to_match
FROM k
""",
    "ams_trip_id": f"""
WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate AS date_sail,
         o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS date_land
  FROM orders),
m AS (SELECT *, date_sail + (date_land - date_sail) / 2 AS mid FROM t),
d AS ({_MID_DOCS}),
x AS (
  SELECT m.*,
    (SELECT max(d.docid) FROM d WHERE d.permit = m.o_custkey AND m.mid BETWEEN d.date_sail AND d.date_land) AS docid,
    (SELECT max(l.l_partkey) FROM lineitem l WHERE l.l_orderkey = m.o_orderkey) AS phone_serial
  FROM m)
SELECT o_orderkey, o_custkey, o_orderpriority, docid,
  CAST(CASE WHEN docid IS NOT NULL THEN docid
            WHEN o_orderpriority = '2-HIGH' AND phone_serial IS NOT NULL THEN phone_serial
            ELSE o_orderkey END AS DECIMAL(38,0)) AS rtl_trip_id,
  CASE WHEN docid IS NOT NULL THEN 'DOCID'
       WHEN o_orderpriority = '2-HIGH' AND phone_serial IS NOT NULL THEN 'VTRSERNO'
       ELSE 'AMS-TRIP_ID-' || coalesce(o_orderpriority, '') END AS rtl_trip_id_source
FROM x
""",
    "jurisdiction": """
SELECT c_custkey, c_nationkey,
  CASE WHEN c_nationkey IN (SELECT DISTINCT n_nationkey FROM nation WHERE n_regionkey = 1) THEN 'STATE'
       WHEN c_nationkey IN (SELECT DISTINCT n_nationkey FROM nation WHERE n_regionkey IN (1, 2)) THEN 'FEDERAL'
  END AS vessel_jurisdiction
FROM customer
""",
    "dealer_name_gate": f"""
WITH c AS ({_CATCH}),
s AS (SELECT s_suppkey, CAST(1995 + s_suppkey % 7 AS INTEGER) AS yr, s_name FROM supplier)
SELECT c.l_orderkey, c.l_partkey, c.l_suppkey, c.l_linenumber, c.dealer_num,
  CAST(year(c.l_shipdate) AS INTEGER) AS sale_year,
  CASE WHEN c.dealer_num IN (1, 2, 4, 5, 7, 8, 99998) OR (c.species_id = 'NC' AND c.dealer_num IS NULL) THEN 'NA'
       ELSE s.s_name END AS dealer_name
FROM c LEFT JOIN s ON s.s_suppkey = c.dealer_num AND s.yr = year(c.l_shipdate)
""",
    "stock_gate": """
SELECT p.p_partkey, p.p_size, p.p_partkey % 5 AS area,
  CASE WHEN p.p_size IN (1, 4, 7, 10, 13, 16, 19, 22, 25, 28, 31, 34, 37) THEN n.n_name ELSE 'NA' END AS stock_id
FROM part p LEFT JOIN nation n ON n.n_nationkey + 1 = p.p_size AND n.n_regionkey = p.p_partkey % 5
""",
    "plan_year": """
WITH cal(plan, calendar) AS (VALUES ('STANDARD', 'JAN TO DEC'), ('ECONOMY', 'MAR TO FEB'), ('MEDIUM', 'MAY TO APR'),
                                    ('SMALL', 'NOV TO OCT'), ('LARGE', 'JUN TO MAY')),
r AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, o.o_orderdate, p.p_type AS fmm, cal.calendar AS fishing_year_range
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN cal ON cal.plan = p.p_type)
SELECT l_orderkey, l_partkey, l_linenumber, fmm, fishing_year_range,
  CAST(CASE fishing_year_range
         WHEN 'JAN TO DEC' THEN year(o_orderdate)
         WHEN 'MAR TO FEB' THEN CASE WHEN month(o_orderdate) >= 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END
         WHEN 'MAY TO APR' THEN CASE WHEN month(o_orderdate) >= 5 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END
         WHEN 'NOV TO OCT' THEN CASE WHEN month(o_orderdate) >= 11 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END
       END AS INTEGER) AS fmp_year
FROM r
""",
    "project_validity": """
WITH v AS (
  SELECT c.c_name AS project, min(o.o_orderdate) AS vf, max(o.o_orderdate) AS vt
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderstatus = 'F' GROUP BY c.c_name)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate,
  CASE WHEN v.project IS NULL THEN NULL
       WHEN CAST(o.o_orderdate AS DATE) BETWEEN CAST(v.vf AS DATE) AND CAST(v.vf + INTERVAL 182 DAY AS DATE) THEN 'Y'
       WHEN CAST(o.o_orderdate AS DATE) BETWEEN CAST(v.vt - INTERVAL 182 DAY AS DATE) AND CAST(v.vt AS DATE) THEN 'Y'
       ELSE 'N' END AS project_status_valid
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN v ON v.project = c.c_name
""",
    "project_backfill": """
WITH f AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_orderkey AS DECIMAL(38,0)) END AS docid,
         CASE WHEN l_linenumber <> 3 THEN CAST(l_orderkey // 40 * 10 + l_linenumber AS VARCHAR)
           || CASE WHEN l_linenumber = 2 THEN '  ' ELSE '' END END AS vtrserno,
         lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS nespp3,
         CASE WHEN l_linenumber % 2 = 0 THEN 'P' || CAST(l_orderkey AS VARCHAR) END AS rsa_ivr_project_id,
         CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey END AS rsa_sfd_project_id
  FROM lineitem),
c AS (
  SELECT CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_orderkey AS DECIMAL(38,0)) END AS docid, CAST(l_orderkey // 40 * 10 + l_linenumber AS VARCHAR) AS serial,
         lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS nespp3, 'IVR-' || CAST(l_suppkey AS VARCHAR) AS ivr_project,
         CASE WHEN l_partkey % 9 <> 0 THEN l_partkey END AS sfd_project
  FROM lineitem WHERE l_returnflag = 'R'),
r1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY docid, serial, nespp3 ORDER BY ivr_project DESC, sfd_project DESC NULLS LAST) AS n
       FROM c WHERE docid IS NOT NULL) WHERE n = 1),
r2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY serial, nespp3 ORDER BY ivr_project DESC, sfd_project DESC NULLS LAST) AS n
       FROM c WHERE docid IS NULL) WHERE n = 1),
r3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY serial, nespp3 ORDER BY ivr_project DESC, sfd_project DESC NULLS LAST) AS n FROM c) WHERE n = 1),
m AS (
  SELECT f.*, CASE WHEN r1.n = 1 THEN 'DOCID-SERIAL' WHEN r2.n = 1 THEN 'SERIAL' WHEN r3.n = 1 THEN 'SERIAL-NO-DOCID' END AS matched_by,
         CASE WHEN r1.n = 1 THEN r1.ivr_project WHEN r2.n = 1 THEN r2.ivr_project WHEN r3.n = 1 THEN r3.ivr_project END AS ivr_project,
         CASE WHEN r1.n = 1 THEN r1.sfd_project WHEN r2.n = 1 THEN r2.sfd_project WHEN r3.n = 1 THEN r3.sfd_project END AS sfd_project
  FROM f LEFT JOIN r1 ON r1.docid = f.docid AND r1.serial = trim(f.vtrserno) AND r1.nespp3 = f.nespp3
         LEFT JOIN r2 ON r2.serial = trim(f.vtrserno) AND r2.nespp3 = f.nespp3
         LEFT JOIN r3 ON f.docid IS NULL AND r3.serial = trim(f.vtrserno) AND r3.nespp3 = f.nespp3)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, docid, vtrserno,
  coalesce(rsa_ivr_project_id, ivr_project) AS rsa_ivr_project_id, coalesce(rsa_sfd_project_id, sfd_project) AS rsa_sfd_project_id, matched_by
FROM m
""",
    "fill_defaults": """
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber,
  coalesce(CASE WHEN p.p_size > 25 THEN 'Y' END, 'N') AS rsa_spp,
  coalesce(CASE WHEN p.p_type = 'STANDARD' THEN p.p_brand END, 'UNKNOWN') AS rsa_program
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
""",
    "trip_categories": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN 'COMMERCIAL' WHEN 2 THEN 'PARTY' WHEN 3 THEN 'CHARTER' WHEN 4 THEN 'RSA' END AS tripcatg_desc,
  CASE l_linenumber - 1 WHEN 0 THEN 'EFFORT FISHING TRIP' WHEN 1 THEN 'SET ONLY TRIP' WHEN 2 THEN 'MECHANICAL BREAKDOWN'
       WHEN 3 THEN 'TURNAROUND DUE TO WEATHER' WHEN 4 THEN 'TRANSITING TRIP' WHEN 5 THEN 'HERRING CARRIER VESSEL'
       WHEN 6 THEN 'TURNAROUND ILLNESS/INJURY' WHEN 7 THEN 'OTHER' END AS trip_activity_type_desc
FROM lineitem
""",
    "species_programs": """
SELECT DISTINCT 1 AS rsa_spp, p_type AS nespp3, p_brand AS rsa_program
FROM part WHERE p_size > 25
ORDER BY rsa_program, nespp3
""",
    "state_name_lookup": """
SELECT c.c_custkey, c.c_nationkey, n.n_name AS state_name
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""",
}
