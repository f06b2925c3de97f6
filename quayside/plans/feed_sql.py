"""DuckDB statements for the whole-feed queries.

The domain tables are re-derived from the driver tables as CTEs (the same
rules as ``feed_standins``), then each feed is written in its literal
relational form: correlated subqueries for the per-row lookups, a global
LAG, ``IN`` lists, CASE chains.  Column names and types follow the targets.
"""

from __future__ import annotations

# Fixed values mirrored from the Spark derivations (stand-in data rules).
_PERMIT = "CAST({c} + 100000 AS VARCHAR)"

CTE = {
    "ams_trip": f"""ams_trip AS (
  SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS das_id, CAST(o_orderkey AS DECIMAL(38,0)) AS trip_id,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 'IVR' ELSE 'DAS' END AS trip_source,
         {_PERMIT.format(c='o_custkey')} AS permit_nbr,
         (['SES', 'MNK', 'MID', 'HER', 'XYZ'])[CAST(o_custkey % 5 AS INTEGER) + 1] || '-' ||
           CASE WHEN o_orderkey % 3 = 0 THEN 'RSA' ELSE 'GEN' END || '-' ||
           lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') ||
           CASE WHEN o_orderkey % 5 = 0 THEN 'R' ELSE 'X' END AS activity_code,
         o_orderdate AS date_sail,
         o_orderdate + to_days(CAST(o_orderkey % 4 AS INTEGER)) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS date_land
  FROM orders)""",
    "document": f"""document AS (
  SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS docid,
         CASE WHEN o_custkey % 97 <> 0 THEN CAST(o_custkey AS DECIMAL(38,0)) END AS vessel_id,
         o_orderdate - INTERVAL 1 DAY AS date_sail, o_orderdate + INTERVAL 6 DAY AS date_land,
         CAST(o_orderkey % 4 + 1 AS INTEGER) AS tripcatg, CAST(o_orderkey % 7 AS INTEGER) AS crew,
         'PORT' || CAST(o_custkey % 30 AS VARCHAR) AS port1,
         {_PERMIT.format(c='o_custkey')} AS vessel_permit_num,
         CAST(o_orderkey % 9 AS INTEGER) AS trip_activity_type
  FROM orders)""",
    "ivr_trip": f"""ivr_trip AS (
  SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS rsa_tripid, 'CLOSED' AS rsa_trip_status,
         o_orderdate + INTERVAL 2 DAY AS rsa_trip_de,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '0'
              WHEN o_orderkey % 29 = 0 THEN '7B2'
              ELSE CAST(o_orderkey * 10 + 10000001 AS VARCHAR) END AS rsa_vtrnbr,
         CASE WHEN o_custkey % 89 <> 0 THEN {_PERMIT.format(c='o_custkey')} END AS vessel_permit_number,
         (['SCALLOP', 'MONKFISH', 'MID-ATLANTIC', 'HERRING'])[CAST(o_custkey % 4 AS INTEGER) + 1] AS rsa_program,
         'P' || CAST(o_custkey % 40 AS VARCHAR) AS rsa_ivr_project_id,
         'S' || CAST(o_custkey % 40 AS VARCHAR) AS rsa_sfd_project_id,
         o_orderdate AS date_rsa_trip_started,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL 3 DAY END AS date_rsa_trip_ended
  FROM orders)""",
}

_PROGRAMS = "['SCALLOP', 'MONKFISH', 'MID-ATLANTIC', 'HERRING']"
_EVENTS = "(SELECT * REPLACE (ts - INTERVAL 8215 DAY AS ts) FROM events)"

CTE.update({
    "vms_end_hail": f"""vms_end_hail AS (
  SELECT CAST(event_id AS DECIMAL(38,0)) AS message_id, 'END' AS form_type,
         CAST(event_id AS DECIMAL(38,0)) AS rsa_efp_hail_id, ts AS time_sent,
         {_PERMIT.format(c='user_id')} AS vessel_permit_number, 'H' || CAST(user_id % 100 AS VARCHAR) AS hull_id,
         CASE WHEN event_id % 41 = 0 THEN '5X5' ELSE substr(props, 7, length(props) - 7) END AS vtr_number,
         ({_PROGRAMS})[CAST(user_id % 4 AS INTEGER) + 1] AS rsa_program,
         'PC' || CAST(user_id % 40 AS VARCHAR) AS project_code,
         CAST(NULL AS VARCHAR) AS landing_city, CAST(NULL AS VARCHAR) AS landing_state,
         CAST(NULL AS TIMESTAMP) AS estimated_arrival, ts + INTERVAL 1 DAY AS estimated_offload,
         CAST(NULL AS VARCHAR) AS species_column, CAST(NULL AS VARCHAR) AS species_name,
         'S' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') AS species_code,
         CAST(value AS DECIMAL(18,2)) AS species_kept, CAST(NULL AS DECIMAL(18,2)) AS species_discard,
         CAST(NULL AS VARCHAR) AS herring_area, props AS activity_code
  FROM {_EVENTS} WHERE event_type IS DISTINCT FROM 'signup')""",
    "vms_start_hail": f"""vms_start_hail AS (
  SELECT CAST(event_id AS DECIMAL(38,0)) AS message_id, CAST(event_id AS DECIMAL(38,0)) AS rsa_efp_start_hail_id,
         ts AS time_sent, {_PERMIT.format(c='user_id')} AS vessel_permit_number, CAST(NULL AS VARCHAR) AS hull_id,
         CASE WHEN event_id % 41 = 0 THEN '5X5' ELSE substr(props, 7, length(props) - 7) END AS vtr_number, 'PC' || CAST(user_id % 40 AS VARCHAR) AS project_code,
         CAST(NULL AS VARCHAR) AS landing_city, CAST(NULL AS VARCHAR) AS landing_state,
         CAST(NULL AS TIMESTAMP) AS estimated_arrival,
         CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END AS record_is_deleted, ts AS date_created
  FROM {_EVENTS} WHERE event_type = 'signup')""",
    "species_ref": f"""species_ref AS (
  SELECT nespp3, 'S' || nespp3 AS speciescd,
         CASE WHEN _type = 'PROMO' THEN 'SKATE ' || upper(_name) ELSE upper(_name) END AS spp_common_name,
         CASE WHEN _size > 25 THEN 1 ELSE 0 END AS rsa_spp,
         ({_PROGRAMS})[CAST(nespp3 AS INTEGER) % 4 + 1] AS rsa_program
  FROM (SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS nespp3, max(p_type) AS _type,
               max(p_name) AS _name, max(p_size) AS _size FROM part GROUP BY 1))""",
    "species_itis": """species_itis AS (
  SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS nespp3,
         max(CAST(160000 + (p_partkey % 1000) * 7 AS VARCHAR)) AS itis FROM part GROUP BY 1)""",
    "species_plan": """species_plan AS (
  SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS nespp3, max(p_type) AS plan FROM part GROUP BY 1)""",
    "plan_calendar": """plan_calendar(plan, calendar) AS (
  VALUES ('STANDARD', 'JAN TO DEC'), ('ECONOMY', 'MAR TO FEB'), ('MEDIUM', 'MAY TO APR'),
         ('SMALL', 'NOV TO OCT'), ('LARGE', 'JUN TO MAY'))""",
    "species_code": """species_code AS (
  SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || CAST(p_partkey % 10 AS VARCHAR) AS species_id,
         max(lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')) AS nespp3,
         max(lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || CAST(p_partkey % 10 AS VARCHAR)) AS nespp4
  FROM part GROUP BY 1)""",
    "species_name": """species_name AS (
  SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || CAST(p_partkey % 10 AS VARCHAR) AS nespp4,
         max(upper(p_name)) AS common_name FROM part GROUP BY 1)""",
    "vessel_name": f"""vessel_name AS (
  SELECT {_PERMIT.format(c='c_custkey')} AS permit, max(c_name) AS vessel_name FROM customer GROUP BY 1)""",
    "project": f"""project AS (
  SELECT 'PC' || CAST(c_custkey % 40 AS VARCHAR) AS project_code, 'S' || CAST(c_custkey % 40 AS VARCHAR) AS project_number,
         ({_PROGRAMS})[CAST(c_custkey % 40 % 4 AS INTEGER) + 1] AS program,
         CASE WHEN c_custkey % 80 < 40 THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '2000-01-01' END
           + to_days(CAST(c_custkey % 40 * 30 AS INTEGER)) AS valid_from,
         CASE WHEN c_custkey % 80 < 40 THEN TIMESTAMP '1999-06-01' WHEN c_custkey % 40 % 13 <> 7 THEN TIMESTAMP '2000-12-01' END
           + to_days(CAST(c_custkey % 40 * 30 AS INTEGER)) AS valid_to
  FROM customer)""",
    "permit_category": f"""permit_category AS (
  SELECT {_PERMIT.format(c='o.o_custkey')} AS permit, 'H' || CAST(o.o_custkey % 100 AS VARCHAR) AS hull,
         CAST(160000 + (l.l_partkey % 1000) * 7 AS VARCHAR) AS itis,
         o.o_orderdate AS valid_from,
         CASE WHEN o.o_orderkey % 31 = 0 THEN NULL WHEN o.o_orderkey % 37 = 0 THEN TIMESTAMP '9999-12-31'
              ELSE o.o_orderdate + INTERVAL 365 DAY END AS valid_to,
         substr(o.o_orderpriority, 1, 1) AS category, 'M' || CAST(l.l_linenumber AS VARCHAR) AS moratorium_code,
         CASE WHEN l.l_linenumber % 2 = 0 THEN 'WEEKLY' ELSE 'MONTHLY' END AS report_frequency
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)""",
    "serial_doc": """serial_doc AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber + 10000000 AS VARCHAR) AS serial,
         max(CAST(l_orderkey AS DECIMAL(38,0))) AS docid FROM lineitem GROUP BY 1)""",
})

_FYB = """CAST(year(l_shipdate) AS INTEGER) AS fy_jan_dec,
         CAST(CASE WHEN month(l_shipdate) >= 3 THEN year(l_shipdate) ELSE year(l_shipdate) - 1 END AS INTEGER) AS fy_mar_feb,
         CAST(CASE WHEN month(l_shipdate) >= 5 THEN year(l_shipdate) ELSE year(l_shipdate) - 1 END AS INTEGER) AS fy_may_apr,
         CAST(CASE WHEN month(l_shipdate) >= 11 THEN year(l_shipdate) ELSE year(l_shipdate) - 1 END AS INTEGER) AS fy_nov_oct"""
_LINE_ID = ("CAST(CAST(l_orderkey AS DECIMAL(38,0)) * CAST(1e21 AS DECIMAL(38,0)) + CAST(l_linenumber AS DECIMAL(38,0)) * CAST(1e20 AS DECIMAL(38,0))"
            " + CAST(l_partkey AS DECIMAL(38,0)) * CAST(1e10 AS DECIMAL(38,0)) + CAST(l_suppkey AS DECIMAL(38,0)) AS DECIMAL(38,0))")
_NESPP3_L = "lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')"

CTE.update({
    "ivr_report": """ivr_report AS (
  SELECT CAST(o_orderkey * 10 + 1 AS DECIMAL(38,0)) AS rsa_trip_reportid, CAST(o_orderkey AS DECIMAL(38,0)) AS rsa_tripid,
         CASE WHEN o_orderkey % 17 = 0 THEN 'LEGACY' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'PRELAND' END AS report_type,
         CAST(NULL AS VARCHAR) AS preland_confirmnbr, CAST(NULL AS TIMESTAMP) AS date_estimated_landing_preland
  FROM orders WHERE o_orderkey % 23 <> 0)""",
    "ivr_landing": f"""ivr_landing AS (
  SELECT {_LINE_ID} AS rsa_trip_landingid, CAST(l_orderkey * 10 + 1 AS DECIMAL(38,0)) AS rsa_trip_reportid,
         {_NESPP3_L} AS nespp3, 'S' || {_NESPP3_L} AS speciesid,
         CAST(l_quantity AS DECIMAL(18,2)) AS rsa_trip_landing_lbs,
         {_FYB}, l_shipdate AS date_created
  FROM lineitem)""",
    "research_code": f"""research_code AS (
  SELECT {_PERMIT.format(c='c.c_custkey')} AS permit, 'STATE' AS state_fed
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey = 1
  UNION ALL
  SELECT {_PERMIT.format(c='c.c_custkey')} AS permit, 'FED' AS state_fed
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey IN (1, 2))""",
})


def _fy_by_calendar(d: str, cal: str) -> str:
    return f"""CAST(CASE {cal}
         WHEN 'JAN TO DEC' THEN year({d})
         WHEN 'MAR TO FEB' THEN CASE WHEN month({d}) >= 3 THEN year({d}) ELSE year({d}) - 1 END
         WHEN 'MAY TO APR' THEN CASE WHEN month({d}) >= 5 THEN year({d}) ELSE year({d}) - 1 END
         WHEN 'NOV TO OCT' THEN CASE WHEN month({d}) >= 11 THEN year({d}) ELSE year({d}) - 1 END END AS INTEGER)"""


def _code_list(code: str, where: str) -> str:
    held = "(SELECT * REPLACE (coalesce(valid_to, TIMESTAMP '9999-12-31') AS valid_to) FROM permit_category)"
    return f"(SELECT string_agg(DISTINCT pc.{code}, ',' ORDER BY pc.{code}) FROM {held} pc WHERE {where})"


def _key(*parts: str) -> str:
    return " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)


def _validity(day: str, number: str) -> str:
    windows = f"EXISTS (SELECT 1 FROM project w WHERE w.project_number = {number} AND "
    return (f"CASE WHEN {windows} CAST({day} AS DATE) BETWEEN CAST(w.valid_from AS DATE) AND CAST(w.valid_to AS DATE)) THEN 'Y' "
            f"WHEN {day} IS NOT NULL AND {windows} (w.valid_from IS NOT NULL OR w.valid_to IS NOT NULL)) THEN 'N' END")


def _whole(s: str) -> str:
    """The whole number a text holds, else NULL."""
    return f"CASE WHEN NOT regexp_matches({s}, '[.][0-9]*[1-9]|[eE]-') THEN TRY_CAST(trim({s}) AS DECIMAL(38,0)) END"


def _serial_ok(s: str, allow_zero: bool) -> str:
    ok = f"regexp_matches({s}, '[0-9]') AND ({_whole(s)}) IS NOT NULL"
    return ok if allow_zero else ok + f" AND ({_whole(s)}) <> 0"


def _no_id(docid: str, s: str) -> str:
    """No document, and a serial with a digit that converts to no number: the
    source's CASE reaches the conversion, and fails there."""
    return f"coalesce({docid} IS NULL AND regexp_matches({s}, '[0-9]') AND ({_whole(s)}) IS NULL, false)"



def _with(*names: str) -> str:
    return "WITH " + ",\n".join(CTE[n] for n in names) + ",\n"


_FY = """
  CAST(year({c}) AS INTEGER) AS fy_jan_dec,
  CAST(CASE WHEN month({c}) >= 3 THEN year({c}) ELSE year({c}) - 1 END AS INTEGER) AS fy_mar_feb,
  CAST(CASE WHEN month({c}) >= 5 THEN year({c}) ELSE year({c}) - 1 END AS INTEGER) AS fy_may_apr,
  CAST(CASE WHEN month({c}) >= 11 THEN year({c}) ELSE year({c}) - 1 END AS INTEGER) AS fy_nov_oct"""

FEED_AMS = _with("ams_trip", "document", "ivr_trip") + f"""
t AS (
  SELECT *, date_sail + (date_land - date_sail) / 2 AS mid FROM ams_trip
  WHERE (substr(activity_code, 5, 3) = 'RSA' AND date_land >= TIMESTAMP '1999-08-02')
     OR (substr(activity_code, 13, 1) = 'R' AND date_land >= TIMESTAMP '1999-08-02')),
x AS (
  SELECT t.*,
    (SELECT d.docid FROM document d WHERE d.vessel_permit_num = t.permit_nbr AND t.mid BETWEEN d.date_sail AND d.date_land
     ORDER BY d.date_sail DESC, d.docid DESC LIMIT 1) AS docid,
    (SELECT max(trim(i.rsa_vtrnbr)) FROM ivr_trip i WHERE i.rsa_tripid = t.trip_id) AS phone_serial
  FROM t),
y AS (SELECT *, CASE WHEN trip_source = 'IVR' THEN {_whole('phone_serial')} END AS phone FROM x)
SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'AMS' AS source_data,
  docid, das_id, trip_id, trip_source, permit_nbr, activity_code,
  CASE substr(activity_code, 1, 3) WHEN 'SES' THEN 'SCALLOP' WHEN 'MNK' THEN 'MONKFISH'
       WHEN 'MID' THEN 'MID-ATLANTIC' WHEN 'HER' THEN 'HERRING' END AS rsa_program,
  date_sail, date_land, {_FY.format(c='date_land')},
  trip_id AS source_level1_key_id, CAST(NULL AS DECIMAL(38,0)) AS source_level2_key_id,
  CAST(NULL AS DECIMAL(38,0)) AS source_level3_key_id,
  upper(strftime(date_sail, '%d-%b-%y %H:%M:%S')) AS date_time_sail,
  upper(strftime(date_land, '%d-%b-%y %H:%M:%S')) AS date_time_land,
  CASE WHEN docid IS NOT NULL THEN docid WHEN phone IS NOT NULL THEN phone ELSE trip_id END AS rtl_trip_id,
  CASE WHEN docid IS NOT NULL THEN 'DOCID' WHEN phone IS NOT NULL THEN 'VTRSERNO'
       ELSE 'AMS-TRIP_ID-' || coalesce(trip_source, '') END AS rtl_trip_id_source
FROM y
"""

_CUT_720 = "TIMESTAMP '1999-08-12'"   # day(2001-08-01) - 720 days
_AS_OF = "TIMESTAMP '2001-08-01'"
_AGE = "CAST(epoch_us(" + _AS_OF + ") - epoch_us({c}) AS DOUBLE) / CAST(86400000000 AS DOUBLE)"
_SKATE_CD = "(SELECT speciescd FROM species_ref WHERE spp_common_name LIKE 'SKATE%')"
_SKATE_N3 = "(SELECT nespp3 FROM species_ref WHERE spp_common_name LIKE 'SKATE%')"
_RSA_SPP = "(SELECT nespp3, 'Y' AS rsa_spp, max(rsa_program) AS program FROM species_ref WHERE rsa_spp = 1 GROUP BY 1)"
_TARGET = "(SELECT DISTINCT nespp3, rsa_program AS program, 'Y' AS target FROM species_ref WHERE rsa_spp = 1)"

FEED_VMS = _with("vms_end_hail", "vms_start_hail", "species_ref", "species_itis", "species_plan", "plan_calendar",
                 "vessel_name", "project", "permit_category", "serial_doc") + f"""
h AS (
  SELECT e.*, sd.docid AS _docid, vn.vessel_name, hs.nespp3, si.itis, sp.plan AS fmm, pc.calendar AS fy_range,
         rs.rsa_spp AS _rsa_spp,
         CASE WHEN hs.nespp3 IS NOT NULL THEN coalesce(pt.target, 'N') END AS rsa_project_spp,
         coalesce(e.species_code IN {_SKATE_CD}, false) AS skate
  FROM vms_end_hail e
  LEFT JOIN serial_doc sd ON sd.serial = trim(e.vtr_number)
  LEFT JOIN vessel_name vn ON vn.permit = e.vessel_permit_number
  LEFT JOIN (SELECT speciescd, max(nespp3) AS nespp3 FROM species_ref GROUP BY 1) hs ON hs.speciescd = e.species_code
  LEFT JOIN species_itis si ON si.nespp3 = hs.nespp3
  LEFT JOIN species_plan sp ON sp.nespp3 = hs.nespp3
  LEFT JOIN plan_calendar pc ON pc.plan = sp.plan
  LEFT JOIN {_RSA_SPP} rs ON rs.nespp3 = hs.nespp3
  LEFT JOIN {_TARGET} pt ON pt.nespp3 = hs.nespp3 AND pt.program = e.rsa_program
  WHERE e.estimated_offload >= {_CUT_720}),
ends AS (
  SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'VMS END HAIL' AS source_data,
    coalesce(CAST(_docid AS VARCHAR), '0') || '-0-' || {_key('vessel_permit_number', 'nespp3')} AS docid_dnum_permit_spp_to_match,
    _docid AS docid, message_id, form_type, rsa_efp_hail_id, time_sent, vessel_permit_number, vessel_name,
    CAST(NULL AS VARCHAR) AS vessel_jurisdiction, hull_id, vtr_number, rsa_program, project_code, landing_city,
    landing_state, estimated_arrival, estimated_offload, species_column, species_name, species_code, species_kept,
    species_discard, herring_area, _rsa_spp AS rsa_spp, rsa_project_spp, nespp3, itis AS species_itis,
    species_name AS spp_common_name, fy_range AS fishing_year_range, fmm,
    {_fy_by_calendar('estimated_offload', 'fy_range')} AS fmp_year,
    {_code_list('category', 'pc.permit = h.vessel_permit_number AND pc.hull = h.hull_id AND pc.itis = h.itis AND h.estimated_offload BETWEEN pc.valid_from AND pc.valid_to')} AS fmp_cat_code_list,
    {_code_list('moratorium_code', 'pc.permit = h.vessel_permit_number AND pc.hull = h.hull_id AND pc.itis = h.itis AND h.estimated_offload BETWEEN pc.valid_from AND pc.valid_to')} AS fmp_mort_code_list,
    {_code_list('report_frequency', 'pc.permit = h.vessel_permit_number AND pc.hull = h.hull_id AND pc.itis = h.itis AND h.estimated_offload BETWEEN pc.valid_from AND pc.valid_to')} AS vessel_rpt_freq_list,
    CAST(NULL AS VARCHAR) AS fmp_mri_list, CAST(NULL AS VARCHAR) AS fmp_mri_list_wo_hull,
    CAST(NULL AS VARCHAR) AS fishery_type, {_FY.format(c='estimated_offload')}, activity_code,
    rsa_efp_hail_id AS source_level1_key_id, CAST(NULL AS DECIMAL(38,0)) AS source_level2_key_id,
    CAST(NULL AS DECIMAL(38,0)) AS source_level3_key_id, {_AGE.format(c='time_sent')} AS trip_age_in_days,
    upper(strftime(time_sent, '%d-%b-%y %H:%M:%S')) AS date_time_sent,
    coalesce(CAST(_docid AS VARCHAR), '0') || '-' || {_key('vessel_permit_number', 'nespp3')} AS docid_permit_spp_to_match,
    coalesce(CAST(_docid AS VARCHAR), '0') || '-' || {_key('vessel_permit_number', 'itis')} AS docid_permit_sppitis_to_match,
    coalesce(vtr_number, '0') || '-' || {_key('vessel_permit_number', 'nespp3')} AS vtr_permit_spp_to_match,
    coalesce(vtr_number, '0') || '-' || {_key('vessel_permit_number', 'itis')} AS vtr_permit_sppitis_to_match,
    coalesce(CAST(_docid AS VARCHAR), '0') || '-' || {_key('vessel_permit_number', "CASE WHEN skate THEN '564' ELSE substr(itis, 1, 3) END")} AS docid_permit_sppitis3_to_match,
    coalesce(vtr_number, '0') || '-' || {_key('vessel_permit_number', "CASE WHEN skate THEN '564' ELSE substr(itis, 1, 3) END")} AS vtr_permit_sppitis3_to_match,
    CASE WHEN _docid IS NOT NULL THEN _docid WHEN {_serial_ok('vtr_number', False)} THEN {_whole('vtr_number')}
         ELSE rsa_efp_hail_id END AS rtl_trip_id,
    CASE WHEN _docid IS NOT NULL THEN 'DOCID' WHEN {_serial_ok('vtr_number', False)} THEN 'VTRSERNO'
         ELSE 'RSA_EFP_HAIL_ID' END AS rtl_trip_id_source,
    {_no_id('_docid', 'vtr_number')} AS _dirty
  FROM h),
st AS (
  SELECT s.*, sd.docid AS _docid, vn.vessel_name, pj.program AS _program
  FROM vms_start_hail s
  LEFT JOIN serial_doc sd ON sd.serial = trim(s.vtr_number)
  LEFT JOIN vessel_name vn ON vn.permit = s.vessel_permit_number
  LEFT JOIN (SELECT DISTINCT project_code, program FROM project) pj ON pj.project_code = s.project_code
  WHERE s.record_is_deleted = 0 AND s.date_created >= {_CUT_720}),
starts AS (
  SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'VMS_START' AS source_data,
    coalesce(CAST(_docid AS VARCHAR), '0') || '-0-' || coalesce(vessel_permit_number, '') || '-' AS docid_dnum_permit_spp_to_match,
    _docid AS docid, message_id, 'SAIL' AS form_type, rsa_efp_start_hail_id AS rsa_efp_hail_id, time_sent,
    vessel_permit_number, vessel_name, hull_id, vtr_number, _program AS rsa_program, project_code, landing_city,
    landing_state, estimated_arrival, rsa_efp_start_hail_id AS source_level1_key_id,
    {_AGE.format(c='time_sent')} AS trip_age_in_days, upper(strftime(time_sent, '%d-%b-%y %H:%M:%S')) AS date_time_sent,
    CASE WHEN _docid IS NOT NULL THEN _docid WHEN {_serial_ok('vtr_number', False)} THEN {_whole('vtr_number')}
         ELSE rsa_efp_start_hail_id END AS rtl_trip_id,
    CASE WHEN _docid IS NOT NULL THEN 'DOCID' WHEN {_serial_ok('vtr_number', False)} THEN 'VTRSERNO'
         ELSE 'RSA_EFP_START_HAIL_ID' END AS rtl_trip_id_source,
    {_no_id('_docid', 'vtr_number')} AS _dirty
  FROM st),
u AS (SELECT * FROM ends UNION ALL BY NAME SELECT * FROM starts)
SELECT u.* EXCLUDE (_dirty), {_validity('u.time_sent', 'p1.project_number')} AS project_status_valid
FROM u
LEFT JOIN (SELECT DISTINCT project_code, project_number FROM project) p1 ON p1.project_code = u.project_code
WHERE NOT u._dirty
"""

_CODE_WHERE_IVR = "pc.permit = t.vessel_permit_number AND pc.itis = t.species_itis AND t.date_created BETWEEN pc.valid_from AND pc.valid_to"
_I3 = "CASE WHEN skate THEN '564' ELSE substr(species_itis, 1, 3) END"

FEED_IVR = _with("ivr_trip", "ivr_report", "ivr_landing", "species_ref", "species_itis", "species_plan",
                 "plan_calendar", "vessel_name", "project", "permit_category", "serial_doc", "research_code") + f"""
j AS (
  SELECT a.*, b.rsa_trip_reportid, b.report_type, b.preland_confirmnbr, b.date_estimated_landing_preland,
         c.rsa_trip_landingid, c.nespp3, c.speciesid, c.rsa_trip_landing_lbs, c.fy_jan_dec, c.fy_mar_feb,
         c.fy_may_apr, c.fy_nov_oct, c.date_created
  FROM ivr_trip a
  LEFT JOIN ivr_report b ON a.rsa_tripid = b.rsa_tripid
  LEFT JOIN ivr_landing c ON b.rsa_trip_reportid = c.rsa_trip_reportid
  WHERE a.rsa_trip_de >= {_CUT_720} AND b.report_type <> 'LEGACY'),
t AS (
  SELECT j.*, sd.docid, vn.vessel_name,
    CASE WHEN j.vessel_permit_number IN (SELECT DISTINCT permit FROM research_code WHERE state_fed = 'STATE') THEN 'STATE'
         WHEN j.vessel_permit_number IN (SELECT DISTINCT permit FROM research_code WHERE state_fed = 'FED') THEN 'FEDERAL'
    END AS vessel_jurisdiction,
    si.itis AS species_itis, sp.plan AS fmm, pc.calendar AS fy_range,
    coalesce(j.speciesid IN {_SKATE_CD}, false) AS skate,
    CASE WHEN LAG(j.vessel_permit_number, 1) OVER w = j.vessel_permit_number
         THEN LAG(j.rsa_ivr_project_id, 1) OVER w END AS previous_rsa_ivr_project_id
  FROM j
  LEFT JOIN serial_doc sd ON sd.serial = trim(j.rsa_vtrnbr)
  LEFT JOIN vessel_name vn ON vn.permit = j.vessel_permit_number
  LEFT JOIN species_itis si ON si.nespp3 = j.nespp3
  LEFT JOIN species_plan sp ON sp.nespp3 = j.nespp3
  LEFT JOIN plan_calendar pc ON pc.plan = sp.plan
  WINDOW w AS (ORDER BY j.vessel_permit_number ASC NULLS LAST, j.rsa_trip_landingid ASC NULLS LAST,
               j.rsa_tripid ASC, j.rsa_trip_reportid ASC))
SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'IVR' AS source_data,
  coalesce(CAST(docid AS VARCHAR), '0') || '-0-' || {_key('vessel_permit_number', 'nespp3')} AS docid_dnum_permit_spp_to_match,
  docid, rsa_tripid, rsa_trip_landingid, rsa_trip_status, rsa_trip_de, CAST(NULL AS VARCHAR) AS rsa_trip_confirmnbr, CAST(NULL AS TIMESTAMP) AS rsa_trip_dc,
  CAST(NULL AS VARCHAR) AS rsa_trip_close_confirmnbr, CAST(NULL AS VARCHAR) AS rsa_trip_monkfsh_ovrgflg,
  CAST(NULL AS VARCHAR) AS rsa_trip_uc, CAST(NULL AS TIMESTAMP) AS rsa_trip_du,
  CAST(NULL AS DECIMAL(38,0)) AS permit_projectid, rsa_vtrnbr, CAST(NULL AS DECIMAL(38,0)) AS gear_typeid,
  CAST(NULL AS DECIMAL(38,0)) AS broadstock_areaid, CAST(NULL AS VARCHAR) AS sector_vessel_flag,
  vessel_permit_number, vessel_name, vessel_jurisdiction, rsa_program, rsa_ivr_project_id, rsa_sfd_project_id,
  CAST(NULL AS VARCHAR) AS rsa_sfd_project_title, rsa_trip_reportid, report_type, preland_confirmnbr,
  CAST(NULL AS TIMESTAMP) AS date_estimate_of_landing, CAST(NULL AS DECIMAL(38,0)) AS anticipated_portid,
  CAST(NULL AS DECIMAL(38,0)) AS stateid, CAST(NULL AS VARCHAR) AS state,
  CAST(NULL AS DECIMAL(38,0)) AS rsa_fishing_areaid, CAST(NULL AS VARCHAR) AS preland, speciesid,
  CAST(NULL AS VARCHAR) AS rsa_spp, CAST(NULL AS VARCHAR) AS rsa_project_spp, nespp3,
  CAST(NULL AS VARCHAR) AS spp_common_name, rsa_trip_landing_lbs, date_rsa_trip_ended AS rsa_trip_landing_de,
  fy_range AS fishing_year_range, {_fy_by_calendar('date_rsa_trip_ended', 'fy_range')} AS fmp_year, fmm,
  {_code_list('category', _CODE_WHERE_IVR)} AS fmp_cat_code_list,
  CAST(NULL AS VARCHAR) AS fmp_mort_code_list, CAST(NULL AS VARCHAR) AS vessel_rpt_freq_list,
  CAST(NULL AS VARCHAR) AS fmp_mri_list, CAST(NULL AS VARCHAR) AS fmp_mri_list_wo_hull,
  CAST(NULL AS VARCHAR) AS fishery_type, CAST(NULL AS DECIMAL(18,2)) AS rsa_trip_landing_loligolbs,
  CAST(NULL AS DECIMAL(18,2)) AS rsa_trip_landing_totallbs, fy_jan_dec, fy_mar_feb, fy_may_apr, fy_nov_oct,
  CAST(NULL AS VARCHAR) AS rsa_trip_landing_uc, CAST(NULL AS TIMESTAMP) AS rsa_trip_landing_dc,
  date_rsa_trip_started, date_rsa_trip_ended,
  {_validity('coalesce(t.date_rsa_trip_ended, t.date_rsa_trip_started)', 't.rsa_sfd_project_id')} AS project_status_valid,
  previous_rsa_ivr_project_id, CAST(NULL AS DECIMAL(38,0)) AS portid,
  date_estimated_landing_preland AS date_estimate_landing_preland,
  CAST(NULL AS TIMESTAMP) AS date_estimate_landing_pretrip,
  rsa_tripid AS source_level1_key_id, rsa_trip_reportid AS source_level2_key_id,
  rsa_trip_landingid AS source_level3_key_id, {_AGE.format(c='date_rsa_trip_started')} AS trip_age_in_days,
  upper(strftime(date_rsa_trip_started, '%d-%b-%y %H:%M:%S')) AS date_time_rsa_trip_started,
  upper(strftime(date_rsa_trip_ended, '%d-%b-%y %H:%M:%S')) AS date_time_rsa_trip_ended,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || {_key('vessel_permit_number', 'nespp3')} AS docid_permit_spp_to_match,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || {_key('vessel_permit_number', 'species_itis')} AS docid_permit_sppitis_to_match,
  coalesce(rsa_vtrnbr, '0') || '-' || {_key('vessel_permit_number', 'nespp3')} AS vtr_permit_spp_to_match,
  coalesce(rsa_vtrnbr, '0') || '-' || {_key('vessel_permit_number', 'species_itis')} AS vtr_permit_sppitis_to_match,
  coalesce(CAST(docid AS VARCHAR), '0') || '-' || {_key('vessel_permit_number', _I3)} AS docid_permit_sppitis3_to_match,
  coalesce(rsa_vtrnbr, '0') || '-' || {_key('vessel_permit_number', _I3)} AS vtr_permit_sppitis3_to_match,
  CASE WHEN docid IS NOT NULL THEN docid WHEN {_serial_ok('rsa_vtrnbr', False)} THEN {_whole('rsa_vtrnbr')}
       ELSE rsa_tripid END AS rtl_trip_id,
  CASE WHEN docid IS NOT NULL THEN 'DOCID' WHEN {_serial_ok('rsa_vtrnbr', False)} THEN 'VTRSERNO'
       ELSE 'RSA_TRIPID' END AS rtl_trip_id_source,
  species_itis
FROM t
WHERE NOT coalesce(vessel_permit_number IN ('111111', '555555', '888888'), false)
  AND NOT {_no_id('docid', 'rsa_vtrnbr')}
"""


def _sql_type(t: str) -> str:
    return {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT"}.get(t, t.upper())


def _declared(ddl_text: str) -> list[tuple[str, str]]:
    out = []
    for field in ddl_text.replace("decimal(38,0)", "decimal(38;0)").replace("decimal(18,2)", "decimal(18;2)") \
            .replace("decimal(18,6)", "decimal(18;6)").split(","):
        name, typ = field.split()
        out.append((name, _sql_type(typ.replace(";", ","))))
    return out


def _conformed(table: str, exprs: dict, source: str) -> str:
    """``table AS (SELECT <declared columns, typed; missing ones NULL> FROM source)``."""
    from quayside.sources.schemas import DIMENSIONS, SOURCES
    ddl = SOURCES.get(table) or DIMENSIONS[table]
    cols = [f"CAST({exprs[n]} AS {t}) AS {n}" if n in exprs else f"CAST(NULL AS {t}) AS {n}" for n, t in _declared(ddl)]
    return f"{table} AS (\n  SELECT " + ",\n         ".join(cols) + f"\n  {source})"


_SERIAL_L = "CAST(l_orderkey * 10 + l_linenumber + 10000000 AS VARCHAR)"
_DEALER_NUM = "CASE WHEN l_suppkey = 0 THEN NULL WHEN l_suppkey = 99 THEN 99998 ELSE l_suppkey END"
_NESPP4_L = "lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || CAST(l_partkey % 10 AS VARCHAR)"

CTE.update({
    "dealer_landing": _conformed("dealer_landing", {
        "docid": "CASE WHEN l_orderkey % 3 <> 1 THEN l_orderkey END", "year": "year(l_shipdate)",
        "dealnum": "l_suppkey", "permit": f"CASE WHEN o_custkey % 83 <> 0 THEN {_PERMIT.format(c='o_custkey')} END",
        "hullnum": "CASE WHEN o_custkey % 71 <> 0 THEN 'H' || CAST(o_custkey % 100 AS VARCHAR) END", "nespp4": _NESPP4_L, "nespp3": _NESPP3_L,
        "spplndlb": "l_quantity", "sppvalue": "l_extendedprice",
        "vtrserno": f"CASE WHEN l_linenumber = 1 THEN '0' WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN 'ABC' "
                    f"WHEN l_linenumber = 6 AND l_orderkey % 101 = 0 THEN '12A4' "
                    f"WHEN l_linenumber = 5 AND l_orderkey % 103 = 0 THEN {_SERIAL_L} || '.5' ELSE {_SERIAL_L} END",
        "species_itis": "lpad(CAST(l_partkey AS VARCHAR), 8, '0')",
        "dealer_rpt_id": "l_orderkey + 12345678901234", "landing_seq": _LINE_ID, "ddate": "l_shipdate",
    }, "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "landing_source": _conformed("landing_source", {
        "landing_seq": _LINE_ID, "catch_source": "CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'D' END"},
        "FROM lineitem"),
    "images": _conformed("images", {
        "imgid": "l_orderkey * 10 + l_linenumber", "docid": "l_orderkey", "serial_num": _SERIAL_L,
        "area": "CAST(_s % 25 + 500 AS VARCHAR)", "gearcode": "'G' || CAST(_s % 9 AS VARCHAR)", "depth": "_q"},
        "FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS _s, min(l_quantity) AS _q FROM lineitem GROUP BY 1, 2)"),
    "catch": _conformed("catch", {
        "catch_id": _LINE_ID, "imgid": "l_orderkey * 10 + l_linenumber",
        "species_id": f"CASE WHEN l_linenumber = 7 AND l_suppkey % 2 = 0 THEN 'NC' ELSE {_NESPP4_L} END",
        "kept": "l_quantity", "discarded": "l_discount * 10", "dealer_num": _DEALER_NUM, "date_sold": "l_shipdate"},
        "FROM lineitem"),
    "document_full": _conformed("document", {
        "docid": "o_orderkey", "vessel_id": "CASE WHEN o_custkey % 97 <> 0 THEN o_custkey END",
        "date_sail": "o_orderdate - INTERVAL 1 DAY", "date_land": "o_orderdate + INTERVAL 6 DAY",
        "tripcatg": "o_orderkey % 4 + 1", "crew": "o_orderkey % 7", "port1": "'PORT' || CAST(o_custkey % 30 AS VARCHAR)",
        "vessel_permit_num": _PERMIT.format(c="o_custkey"), "trip_activity_type": "o_orderkey % 9"},
        "FROM orders").replace("document AS (", "document_full AS (", 1),
    "stock_area": """stock_area AS (
  SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS nespp3, CAST(p_size % 25 + 500 AS VARCHAR) AS area,
         max('STK' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '-' || CAST(p_size % 25 + 500 AS VARCHAR)) AS stock_id
  FROM part GROUP BY 1, 2)""",
    "conversion": """conversion AS (
  SELECT lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || CAST(p_partkey % 10 AS VARCHAR) AS species_id,
         CAST(p_partkey % 100 AS DECIMAL(38,0)) AS dealer_num,
         max(CAST(1 + p_size / 100 AS DECIMAL(18,6))) AS factor
  FROM part GROUP BY 1, 2)""",
    "dealer_year": """dealer_year AS (
  SELECT CAST(s_suppkey AS DECIMAL(38,0)) AS dealer_num, CAST(1995 + s_suppkey % 7 AS INTEGER) AS year,
         max(s_name) AS dealer_name FROM supplier GROUP BY 1, 2)""",
})


def _reported(name: str, keys: str, where: str) -> str:
    """The greatest report per key."""
    return f"""{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ivr_project DESC NULLS LAST, sfd_project DESC NULLS LAST) AS n
                 FROM phoned WHERE {where}) WHERE n = 1)"""


def _reported_joins(serial: str) -> str:
    """Document, serial and species; else a report, else a row without document."""
    same = f"serial = nullif(trim({serial}), '') AND {{r}}.nespp3 = e.nespp3"
    return (f"LEFT JOIN reported1 r1 ON r1.docid = e.docid AND r1.{same.format(r='r1')}\n"
            f"LEFT JOIN reported2 r2 ON r2.{same.format(r='r2')}\n"
            f"LEFT JOIN reported3 r3 ON e.docid IS NULL AND r3.{same.format(r='r3')}")


def _reported_id(column: str) -> str:
    return f"CASE WHEN r1.n = 1 THEN r1.{column} WHEN r2.n = 1 THEN r2.{column} WHEN r3.n = 1 THEN r3.{column} END"


def _upstream_ctes() -> str:
    """AMS, IVR and VMS outputs as nested statements, plus the trip sets and
    the reported-project lookup the dealer and vessel feeds read."""
    return f"""ams_out AS ({FEED_AMS}),
ivr_out AS ({FEED_IVR}),
vms_out AS ({FEED_VMS}),
docids AS (SELECT docid FROM ams_out UNION SELECT docid FROM document WHERE tripcatg = 4
           UNION SELECT docid FROM ivr_out UNION SELECT docid FROM vms_out),
named AS (SELECT trim(rsa_vtrnbr) AS serial FROM ivr_out UNION SELECT trim(vtr_number) FROM vms_out),
serials AS (SELECT serial FROM named WHERE {_serial_ok('serial', False)}),
phoned AS (
  SELECT docid, trim(rsa_vtrnbr) AS serial, nespp3, rsa_ivr_project_id AS ivr_project, rsa_sfd_project_id AS sfd_project
  FROM ivr_out
  WHERE rsa_vtrnbr IS NOT NULL AND nespp3 IS NOT NULL AND (rsa_ivr_project_id IS NOT NULL OR rsa_sfd_project_id IS NOT NULL)),
{_reported('reported1', 'docid, serial, nespp3', 'docid IS NOT NULL')},
{_reported('reported2', 'serial, nespp3', 'docid IS NULL')},
{_reported('reported3', 'serial, nespp3', 'true')},
"""

_CUT_730 = "TIMESTAMP '1999-08-02'"   # day(2001-08-01) - 730 days
_DEALER_PASS = """docid year drid_landseq_src port state port_name port_state port2 county link month docn day dealnum
    dealer_name vessel_name permit hullnum nespp4 nespp3 spplndlb spplivlb sppvalue vtrserno reported_quantity
    disposition_code disposition_desc species_itis uom grade_code market_code gear_code dersource cf_license
    partner_id partner_code partner_affiliation state_dnum negear_vtr dealer_rpt_id landing_seq doe entry_date ddate
    spp_common_name grade_desc market_desc landing_date_safis""".split()
_I3_NZ = "CASE WHEN skate THEN '564' ELSE substr(itis_nz, 1, 3) END"


def _dealer_sql() -> str:
    pass_cols = ", ".join(f"e.{c}" for c in _DEALER_PASS)
    cat = _code_list("category", "pc.permit = e.permit AND pc.itis = e.itis_nz AND e.land BETWEEN pc.valid_from AND pc.valid_to")
    mort = _code_list("moratorium_code", "pc.permit = e.permit AND pc.hull = e.hullnum AND pc.itis = e.itis_nz "
                                         "AND e.land BETWEEN pc.valid_from AND pc.valid_to")
    return _with("dealer_landing", "landing_source", "document", "ams_trip", "ivr_trip", "ivr_report", "ivr_landing",
                 "vms_end_hail", "vms_start_hail", "species_ref", "species_itis", "species_plan", "plan_calendar",
                 "vessel_name", "project", "permit_category", "serial_doc", "research_code") + _upstream_ctes() + f"""
q AS (
  SELECT dl.*, ls.catch_source
  FROM dealer_landing dl LEFT JOIN landing_source ls ON ls.landing_seq = dl.landing_seq
  WHERE (dl.docid IN (SELECT DISTINCT docid FROM docids) AND dl.ddate >= {_CUT_730})
     OR (trim(dl.vtrserno) IN (SELECT DISTINCT serial FROM serials) AND dl.ddate >= {_CUT_730})
     OR (ls.catch_source = 'R' AND dl.ddate >= {_CUT_730})),
e AS (
  SELECT q.*, rs.rsa_spp AS _rsa_spp, rs.program AS _rsa_program,
         CASE WHEN q.nespp3 IS NOT NULL THEN coalesce(pt.target, 'N') END AS _target,
         sp.plan AS fmm, pc.calendar AS fy_range, coalesce(q.nespp3 IN {_SKATE_N3}, false) AS skate,
         coalesce(dd.date_land, q.ddate) AS land, nullif(ltrim(q.species_itis, '0'), '') AS itis_nz
  FROM q
  LEFT JOIN {_RSA_SPP} rs ON rs.nespp3 = q.nespp3
  LEFT JOIN {_TARGET} pt ON pt.nespp3 = q.nespp3 AND pt.program = rs.program
  LEFT JOIN species_plan sp ON sp.nespp3 = q.nespp3
  LEFT JOIN plan_calendar pc ON pc.plan = sp.plan
  LEFT JOIN (SELECT docid, max(date_land) AS date_land FROM document GROUP BY 1) dd ON dd.docid = q.docid)
SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'DEALER' AS source_data,
  coalesce(CAST(e.docid AS VARCHAR), '0') || '-' || coalesce(CAST(e.dealnum AS VARCHAR), '0') || '-' ||
    {_key('e.permit', 'e.nespp3')} AS docid_dnum_permit_spp_to_match,
  {pass_cols},
  coalesce(e._rsa_spp, 'N') AS rsa_spp, e._target AS rsa_program_spp, coalesce(e._rsa_program, 'UNKNOWN') AS rsa_program,
  e.fy_range AS fishing_year_range, e.fmm, {cat} AS fmp_cat_code_list, {mort} AS fmp_mort_code_list,
  CAST(NULL AS VARCHAR) AS vessel_rpt_freq_list, CAST(NULL AS VARCHAR) AS fmp_mri_list,
  CAST(NULL AS VARCHAR) AS fmp_mri_list_wo_hull, CAST(NULL AS VARCHAR) AS fishery_type,
  {_fy_by_calendar('e.land', 'e.fy_range')} AS fmp_year, {_FY.format(c='e.ddate')}, e.catch_source,
  e.dealer_rpt_id AS source_level1_key_id, e.landing_seq AS source_level2_key_id,
  CAST(NULL AS DECIMAL(38,0)) AS source_level3_key_id,
  coalesce(CAST(e.docid AS VARCHAR), '0') || '-' || {_key('e.permit', 'e.nespp3')} AS docid_permit_spp_to_match,
  coalesce(CAST(e.docid AS VARCHAR), '0') || '-' || {_key('e.permit', 'e.itis_nz')} AS docid_permit_sppitis_to_match,
  coalesce(e.vtrserno, '0') || '-' || {_key('e.permit', 'e.nespp3')} AS vtr_permit_spp_to_match,
  coalesce(e.vtrserno, '0') || '-' || {_key('e.permit', 'e.itis_nz')} AS vtr_permit_sppitis_to_match,
  coalesce(CAST(e.docid AS VARCHAR), '0') || '-' || {_key('e.permit', _I3_NZ)} AS docid_permit_sppitis3_to_match,
  coalesce(e.vtrserno, '0') || '-' || {_key('e.permit', _I3_NZ)} AS vtr_permit_sppitis3_to_match,
  CASE WHEN e.docid IS NOT NULL THEN e.docid
       WHEN {_serial_ok('e.vtrserno', True)} THEN {_whole('e.vtrserno')}
       ELSE TRY_CAST(concat(CAST(e.dealer_rpt_id AS VARCHAR), e.permit) AS DECIMAL(38,0)) END AS rtl_trip_id,
  CASE WHEN e.docid IS NOT NULL THEN 'DOCID' WHEN {_serial_ok('e.vtrserno', True)} THEN 'VTRSERNO'
       ELSE 'DEALER_RPT_ID-PERMIT' END AS rtl_trip_id_source,
  {_reported_id('ivr_project')} AS rsa_ivr_project_id,
  {_reported_id('sfd_project')} AS rsa_sfd_project_id
FROM e
{_reported_joins('e.vtrserno')}
WHERE NOT {_no_id('e.docid', 'e.vtrserno')}
"""


FEED_DEALER = _dealer_sql()

_DOC_COLS = """docid vessel_id date_sail date_land tripcatg crew nanglers port1 port2 port3 state1 state2 state3
    datelnd2 datelnd3 operator_num operator_name date_signed fished vessel_permit_num origin trip_activity_type""".split()
_IMG_COLS = """imgid date_received serial_num gearcode gearqty gearsize area depth lat_degree lat_minute lat_second
    lat_dir lon_degree lon_minute lon_second lon_dir ntows towhrs towmin mesh""".split()
_CATCH_COLS = """catch_id species_id kept discarded dealer_num date_sold port_landed state_landed port_number""".split()
_STOCK_SPECIES = "('081', '120', '122', '123', '124', '125', '147', '153', '159', '240', '250', '269', '512')"
_NON_DEALER = "(1, 2, 4, 5, 7, 8, 99998)"


def _vessel_sql() -> str:
    doc = ", ".join(f"d.{c}" for c in _DOC_COLS)
    img = ", ".join(f"i.{c}" for c in _IMG_COLS)
    cat = ", ".join(f"c.{c}" for c in _CATCH_COLS)
    code = _code_list("category", "pc.permit = e.vessel_permit_num AND pc.itis = e._itis "
                                  "AND e.date_land BETWEEN pc.valid_from AND pc.valid_to")
    i3 = "CASE WHEN e.skate THEN '564' ELSE substr(e._itis, 1, 3) END"
    return _with("document", "document_full", "images", "catch", "ams_trip", "ivr_trip", "ivr_report", "ivr_landing",
                 "vms_end_hail", "vms_start_hail", "species_ref", "species_itis", "species_plan", "plan_calendar",
                 "species_code", "species_name", "vessel_name", "project", "permit_category", "serial_doc",
                 "research_code", "stock_area", "conversion", "dealer_year") + _upstream_ctes() + f"""
t AS (
  SELECT {doc}, {img}, {cat}
  FROM document_full d, images i, catch c
  WHERE d.vessel_id IS NOT NULL AND d.docid = i.docid AND i.imgid = c.imgid
    AND d.docid IN (SELECT DISTINCT docid FROM docids) AND d.date_land >= {_CUT_730}),
e AS (
  SELECT t.*, sc.nespp3, sc.nespp4, sn.common_name AS spp_common_name, si.itis AS _itis, sp.plan AS fmm,
         pc.calendar AS fy_range, rs.rsa_spp AS _rsa_spp, rs.program AS _rsa_program,
         CASE WHEN sc.nespp3 IS NOT NULL THEN coalesce(pt.target, 'N') END AS _target,
         coalesce(sc.nespp3 IN {_SKATE_N3}, false) AS skate, vn.vessel_name, sa.stock_id AS _stock,
         cv.factor AS _factor, dy.dealer_name AS _dealer
  FROM t
  LEFT JOIN species_code sc ON sc.species_id = t.species_id
  LEFT JOIN species_name sn ON sn.nespp4 = sc.nespp4
  LEFT JOIN species_itis si ON si.nespp3 = sc.nespp3
  LEFT JOIN species_plan sp ON sp.nespp3 = sc.nespp3
  LEFT JOIN plan_calendar pc ON pc.plan = sp.plan
  LEFT JOIN {_RSA_SPP} rs ON rs.nespp3 = sc.nespp3
  LEFT JOIN {_TARGET} pt ON pt.nespp3 = sc.nespp3 AND pt.program = rs.program
  LEFT JOIN vessel_name vn ON vn.permit = t.vessel_permit_num
  LEFT JOIN stock_area sa ON sa.nespp3 = sc.nespp3 AND sa.area = t.area
  LEFT JOIN conversion cv ON cv.species_id = t.species_id AND cv.dealer_num = t.dealer_num
  LEFT JOIN dealer_year dy ON dy.dealer_num = t.dealer_num AND dy.year = year(t.date_sold))
SELECT CAST(1 AS BIGINT) AS rtl_seq_no, '01-AUG-01' AS date_downloaded, 'VESSEL' AS source_data,
  {_key('e.docid', "coalesce(CAST(e.dealer_num AS VARCHAR), '0')", 'e.vessel_permit_num', 'e.nespp3')} AS docid_dnum_permit_spp_to_match,
  {", ".join("e." + c for c in _DOC_COLS)},
  CASE e.tripcatg WHEN 1 THEN 'COMMERCIAL' WHEN 2 THEN 'PARTY' WHEN 3 THEN 'CHARTER' WHEN 4 THEN 'RSA' END AS tripcatg_desc,
  e.vessel_name,
  CASE e.trip_activity_type WHEN 0 THEN 'EFFORT FISHING TRIP' WHEN 1 THEN 'SET ONLY TRIP' WHEN 2 THEN 'MECHANICAL BREAKDOWN'
       WHEN 3 THEN 'TURNAROUND DUE TO WEATHER' WHEN 4 THEN 'TRANSITING TRIP' WHEN 5 THEN 'HERRING CARRIER VESSEL'
       WHEN 6 THEN 'TURNAROUND ILLNESS/INJURY' WHEN 7 THEN 'OTHER' END AS trip_activity_type_desc,
  {_FY.format(c='e.date_land')},
  {", ".join("e." + c for c in _IMG_COLS)}, {", ".join("e." + c for c in _CATCH_COLS)}, e.spp_common_name,
  coalesce(e._rsa_spp, 'N') AS rsa_spp, e._target AS rsa_project_spp, e._rsa_program AS rsa_program, e.nespp3,
  CASE WHEN e.nespp3 IN {_STOCK_SPECIES} THEN e._stock ELSE 'NA' END AS stock_id,
  e.kept AS landed_pounds, e.kept * e._factor AS live_pounds, e.fy_range AS fishing_year_range,
  {_fy_by_calendar('e.date_land', 'e.fy_range')} AS fmp_year, e.fmm, {code} AS fmp_cat_code_list,
  CAST(NULL AS VARCHAR) AS fmp_mort_code_list, CAST(NULL AS VARCHAR) AS vessel_rpt_freq_list,
  CAST(NULL AS VARCHAR) AS fmp_mri_list, CAST(NULL AS VARCHAR) AS fmp_mri_list_wo_hull,
  CAST(NULL AS VARCHAR) AS fishery_type,
  CASE WHEN e.dealer_num IN {_NON_DEALER} THEN 'NON-DEALER' ELSE 'DEALER' END AS dealer_type,
  CASE WHEN e.species_id = 'NC' AND e.dealer_num IS NULL THEN 'NO CATCH REPORTED'
       WHEN e.dealer_num = 1 THEN 'SEIZED' WHEN e.dealer_num = 2 THEN 'BAIT' WHEN e.dealer_num = 3 THEN '?'
       WHEN e.dealer_num = 4 THEN 'RETAINED FOR FUTURE SALE' WHEN e.dealer_num = 5 THEN 'SOLD TO NON-FEDERAL DEALER'
       WHEN e.dealer_num = 7 THEN 'LANDED FOR RESEARCH' WHEN e.dealer_num = 8 THEN 'LUMF, LEGAL SIZE UNMARKETABLE FISH'
       WHEN e.dealer_num = 99998 THEN 'HOME CONSUMPTION' ELSE 'SOLD TO FEDERAL DEALER' END AS disposition_of_catch,
  e.dealer_num AS dealer_number,
  CASE WHEN e.dealer_num IN {_NON_DEALER} OR (e.species_id = 'NC' AND e.dealer_num IS NULL) THEN 'NA'
       ELSE e._dealer END AS dealer_name,
  e.docid AS source_level1_key_id, e.imgid AS source_level2_key_id, e.catch_id AS source_level3_key_id,
  upper(strftime(e.date_sail, '%d-%b-%y %H:%M:%S')) AS date_time_sail,
  upper(strftime(e.date_land, '%d-%b-%y %H:%M:%S')) AS date_time_land,
  {_key('e.docid', 'e.vessel_permit_num', 'e.nespp3')} AS docid_permit_spp_to_match,
  {_key('e.docid', 'e.vessel_permit_num', 'e._itis')} AS docid_permit_sppitis_to_match,
  coalesce(CAST(e.docid AS VARCHAR), '0') || '-' || {_key('e.vessel_permit_num', i3)} AS docid_permit_sppitis3_to_match,
  e.docid AS rtl_trip_id, 'DOCID' AS rtl_trip_id_source, e._itis AS species_itis,
  {_reported_id('ivr_project')} AS rsa_ivr_project_id,
  {_reported_id('sfd_project')} AS rsa_sfd_project_id
FROM e
{_reported_joins('e.serial_num')}
"""


FEED_VESSEL = _vessel_sql()



def _quarantine(feed: str, target: str, keys: str, serial: str, source: str, where: str) -> str:
    """The rows that a feed's statement leaves out for their serial."""
    return feed[:feed.rindex("\nSELECT ")] + f"""
SELECT '{target}' AS target, 'serial has a digit but is not a number' AS reason, {keys}, {serial} AS value
FROM {source} WHERE {where}
"""


FEED_SQL = {
    "landings_by_year": _with("dealer_landing") + f"""
SELECT year(ddate) AS year, CAST(ddate AS DATE) AS day, count(*) AS n, sum(spplndlb) AS pounds, count(DISTINCT docid) AS documents
FROM dealer_landing WHERE ddate >= {_CUT_730} GROUP BY 1, 2""",
    "quarantine_dealer": _quarantine(
        FEED_DEALER, "rsa_rtl_dealer", "dealer_rpt_id AS source_level1_key_id, landing_seq AS source_level2_key_id",
        "vtrserno", "e", _no_id("docid", "vtrserno")),
    "quarantine_ivr": _quarantine(
        FEED_IVR, "rsa_rtl_ivr", "rsa_tripid AS source_level1_key_id, rsa_trip_reportid AS source_level2_key_id",
        "rsa_vtrnbr", "t", "NOT coalesce(vessel_permit_number IN ('111111', '555555', '888888'), false) AND "
        + _no_id("docid", "rsa_vtrnbr")),
    "quarantine_vms": _quarantine(
        FEED_VMS, "rsa_rtl_vms", "rsa_efp_hail_id AS source_level1_key_id, message_id AS source_level2_key_id",
        "vtr_number", "u", "_dirty"),
    "feed_ams": FEED_AMS,
    "feed_vms": FEED_VMS,
    "feed_ivr": FEED_IVR,
    "feed_dealer": FEED_DEALER,
    "feed_vessel": FEED_VESSEL,
}
