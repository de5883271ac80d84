"""SQL building blocks for the oracle queries, over the driver tables."""

from __future__ import annotations

import re

from checks import crm
from funnelry.sources.seeds import packaged_rows


def _values(seed: str) -> str:
    rows = packaged_rows(seed)
    columns = list(rows[0])

    def cell(column: str, value: str | None) -> str:
        if column.startswith("is_"):
            return "CAST(NULL AS BOOLEAN)" if value is None else value.upper()
        return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"

    body = ",\n".join("(" + ", ".join(cell(c, r[c]) for c in columns) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(columns)})"


def _columns(table: dict[str, str]) -> str:
    return ",\n".join(f"{crm.duckdb_sql(x)} AS {n}" for n, x in table.items())


def _load(row: str, feed: str) -> str:
    return (
        f"'{feed}/load_date=' || CASE WHEN v = 0 THEN '2026-05-16' ELSE '2026-05-17' END AS source_file_name, "
        f"{row} + 1 AS source_row_number, "
        "CASE WHEN v = 0 THEN DATE '2026-05-16' ELSE DATE '2026-05-17' END AS load_date, "
        "CASE WHEN v = 0 THEN TIMESTAMP '2026-05-16 07:30:00' ELSE TIMESTAMP '2026-05-17 07:30:00' END AS insert_date"
    )


NEWEST = (
    "activity_updated_at DESC NULLS LAST, activity_at DESC NULLS LAST, load_date DESC, "
    "source_file_name DESC, source_row_number DESC, activity_array_index DESC"
)


def latest(table: str, keys: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * FROM {table} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {NEWEST}) = 1"
    )


def ratio(part: str, whole: str, digits: int = 4) -> str:
    """Half-up rounded quotient of counts in whole numbers, free of float rounding."""
    scale = 10**digits
    return (
        f"CASE WHEN {whole} <> 0 THEN CAST((2 * CAST({part} AS HUGEINT) * {scale} + {whole}) // "
        f"(2 * {whole}) AS DOUBLE) / CAST({scale} AS DOUBLE) END"
    )


def average(total: str, n: str) -> str:
    """Half-up rounded cents of a money total over a count."""
    cents = f"CAST(abs({total}) * 100 AS HUGEINT)"
    return (
        f"CASE WHEN {n} <> 0 THEN sign({total}) * CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) "
        "/ CAST(100 AS DOUBLE) END"
    )


def money(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


NY = "CAST((({}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE)"

CTES = {
    "copies": (
        "SELECT e.*, c.v, c.idx FROM events e, (VALUES (0, 0), (0, 1), (1, 0)) c(v, idx) "
        "WHERE (c.v = 0 AND e.event_id % 97 <> 0 AND (c.idx = 0 OR e.event_id % 7 = 0)) "
        "OR (c.v = 1 AND e.event_id % 10 = 0)"
    ),
    "act": (
        "SELECT event_id, event_type, ts, v, idx AS activity_array_index,\n"
        + _columns(crm.ACTIVITY)
        + ",\n"
        + _load("event_id", "lead_activites_raw")
        + " FROM copies"
    ),
    "custom": latest("act", "lead_id, activity_id", "activity_type = 'CustomActivity'"),
    "types": _values("custom_activity_type_map"),
    "fields": _values("custom_field_map"),
    "outcomes": _values("funnel_outcome_map"),
    "objection_map": _values("objection_category_map"),
    "amounts": """
        SELECT *, CAST(CASE contract_text WHEN '0' THEN 0 WHEN '-5.25' THEN -5.25
               WHEN 'amount' THEN contract_cents / 100.0 END AS DECIMAL(18,2)) AS contract_value,
               CAST(cash_cents / 100.0 AS DECIMAL(18,2)) AS cash_collected,
               CAST(extra_cents / 100.0 AS DECIMAL(18,2)) AS additional_cash_collected,
               CASE WHEN setter_a IS NULL OR setter_b > setter_a THEN setter_b ELSE setter_a END AS setter_field,
               CASE WHEN closer_a IS NULL OR closer_b > closer_a THEN closer_b ELSE closer_a END AS closer_field
        FROM custom""",
    "fe": """
        SELECT lead_id, activity_id, a.custom_activity_type_id, activity_at, activity_updated_at, user_id,
               t.funnel_source, t.funnel_stage, triage_outcome, prospecting_outcome, strategy_outcome,
               offer_presented, objections AS objections_faced, contract_value, cash_collected,
               coalesce(setter_field, user_id) AS setter_user_id,
               coalesce(closer_field, user_id) AS closer_user_id
        FROM amounts a JOIN types t ON a.custom_activity_type_id = t.custom_activity_type_id
        WHERE t.is_active AND t.funnel_stage IN ('initial_contact', 'strategy', 'sale')""",
    "step1": """
        SELECT i.lead_id, i.funnel_source, i.activity_id AS initial_activity_id,
               i.custom_activity_type_id AS initial_activity_type_id, i.activity_at AS initial_at,
               i.setter_user_id, coalesce(i.triage_outcome, i.prospecting_outcome) AS initial_outcome,
               s.activity_id AS strategy_activity_id,
               s.custom_activity_type_id AS strategy_activity_type_id, s.activity_at AS strategy_at,
               s.closer_user_id, s.strategy_outcome, s.offer_presented, s.objections_faced
        FROM (SELECT * FROM fe WHERE funnel_stage = 'initial_contact') i
        LEFT JOIN (SELECT * FROM fe WHERE funnel_stage = 'strategy') s
          ON s.lead_id = i.lead_id AND s.activity_at >= i.activity_at
        QUALIFY row_number() OVER (PARTITION BY i.lead_id, i.activity_id
                                   ORDER BY s.activity_at NULLS LAST, s.activity_id NULLS LAST) = 1""",
    "fact": """
        SELECT md5(p.lead_id || '|' || initial_activity_id || '|' || coalesce(strategy_activity_id, '')
                   || '|' || coalesce(n.activity_id, '')) AS lead_funnel_id,
               p.*, n.activity_id AS sale_activity_id,
               n.custom_activity_type_id AS sale_activity_type_id, n.activity_at AS sale_at,
               n.contract_value, n.cash_collected,
               CASE WHEN strategy_activity_id IS NULL THEN 'initial_no_strategy'
                    WHEN n.activity_id IS NULL THEN 'initial_to_strategy_no_sale'
                    ELSE 'initial_to_strategy_to_sale' END AS path_category
        FROM step1 p LEFT JOIN (SELECT * FROM fe WHERE funnel_stage = 'sale') n
          ON n.lead_id = p.lead_id AND n.activity_at >= p.strategy_at
        QUALIFY row_number() OVER (PARTITION BY p.lead_id, p.initial_activity_id
                                   ORDER BY n.activity_at NULLS LAST, n.activity_id NULLS LAST) = 1""",
    "user_rows": (
        "SELECT c_custkey, v, "
        + _columns(crm.USER)
        + ", "
        + _load("c_custkey", "close_crm_users_raw")
        + " FROM customer, (VALUES (0), (1)) u(v) WHERE (v = 0 OR c_custkey % 4 = 0) AND c_custkey % 50 <> 49"
    ),
    "users": """
        SELECT *, trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS full_name,
               CAST(date_created AS TIMESTAMP) AS user_created_at,
               CAST(date_updated AS TIMESTAMP) AS user_updated_at
        FROM user_rows
        QUALIFY row_number() OVER (PARTITION BY user_id
                                   ORDER BY CAST(date_updated AS TIMESTAMP) DESC NULLS LAST, insert_date DESC) = 1""",
    "lead_rows": (
        "SELECT c_custkey, v, "
        + _columns(crm.LEAD)
        + ", "
        + _load("c_custkey", "leads_raw")
        + " FROM customer, (VALUES (0), (1)) u(v) WHERE v = 0 OR c_custkey % 3 = 0"
    ),
    "leads": """
        SELECT * FROM lead_rows
        QUALIFY row_number() OVER (PARTITION BY lead_id
                                   ORDER BY lead_updated_at DESC NULLS LAST, insert_date DESC) = 1""",
    "latest_any": latest("act", "activity_id"),
    "evidence": f"""
        SELECT {NY.format('activity_at')} AS report_date, user_id AS setter_user_id, lead_id,
               max(CASE WHEN activity_type = 'Meeting' AND (title ILIKE '%Data Engineer Academy%'
                        OR note ILIKE '%Data Engineer Academy%') THEN 1 ELSE 0 END) AS has_calendar_booking,
               max(CASE WHEN activity_type = 'SMS'
                        AND sequence_name = '001-Triage Booked // Setter Confirmation' THEN 1 ELSE 0 END) AS has_sms_booking
        FROM latest_any GROUP BY ALL""",
    "inbound_paths": """
        SELECT f.*, i.is_set AS initial_is_set, s.is_taken AS strategy_is_taken
        FROM fact f
        LEFT JOIN outcomes i ON i.canonical_field_name = 'triage_outcome' AND i.raw_value = f.initial_outcome
        LEFT JOIN outcomes s ON s.canonical_field_name = 'strategy_outcome' AND s.raw_value = f.strategy_outcome
        WHERE f.funnel_source = 'inbound'""",
    "conclusions": f"""
        SELECT {NY.format('initial_at')} AS report_date, setter_user_id, lead_id,
               max(CASE WHEN trim(initial_outcome) <> '' THEN 1 ELSE 0 END) AS has_triage_conclusion,
               max(CASE WHEN initial_is_set THEN 1 ELSE 0 END) AS has_triage_set,
               count(strategy_activity_id) AS strategy_calls_booked,
               count(*) FILTER (WHERE strategy_activity_id IS NOT NULL AND strategy_is_taken) AS strategy_calls_taken,
               count(*) FILTER (WHERE strategy_activity_id IS NOT NULL AND strategy_is_taken
                                AND offer_presented <> '') AS offers_presented,
               count(sale_activity_id) AS total_sales, sum(contract_value) AS total_contract_value,
               sum(cash_collected) AS total_cash_collected
        FROM inbound_paths GROUP BY ALL""",
    "combined": """
        SELECT coalesce(e.report_date, c.report_date) AS report_date,
               coalesce(e.setter_user_id, c.setter_user_id) AS setter_user_id,
               coalesce(e.lead_id, c.lead_id) AS lead_id,
               coalesce(has_calendar_booking, 0) AS has_calendar_booking,
               coalesce(has_sms_booking, 0) AS has_sms_booking,
               coalesce(has_triage_conclusion, 0) AS has_triage_conclusion,
               coalesce(has_triage_set, 0) AS has_triage_set,
               coalesce(strategy_calls_booked, 0) AS strategy_calls_booked,
               coalesce(strategy_calls_taken, 0) AS strategy_calls_taken,
               coalesce(offers_presented, 0) AS offers_presented,
               coalesce(total_sales, 0) AS total_sales,
               coalesce(total_contract_value, 0) AS total_contract_value,
               coalesce(total_cash_collected, 0) AS total_cash_collected
        FROM evidence e FULL OUTER JOIN conclusions c
          ON e.report_date = c.report_date AND e.setter_user_id = c.setter_user_id AND e.lead_id = c.lead_id""",
    "inbound_rollup": """
        SELECT report_date, setter_user_id,
               count(*) FILTER (WHERE has_calendar_booking = 1 OR has_sms_booking = 1
                                OR has_triage_conclusion = 1) AS inbound_booked,
               count(*) FILTER (WHERE has_triage_conclusion = 1) AS inbound_taken,
               count(*) FILTER (WHERE has_triage_set = 1) AS triage_set,
               CAST(sum(strategy_calls_booked) AS BIGINT) AS strategy_calls_booked,
               CAST(sum(strategy_calls_taken) AS BIGINT) AS strategy_calls_taken,
               CAST(sum(offers_presented) AS BIGINT) AS offers_presented,
               CAST(sum(total_sales) AS BIGINT) AS total_sales,
               sum(total_contract_value) AS total_contract_value,
               sum(total_cash_collected) AS total_cash_collected
        FROM combined GROUP BY ALL""",
    "inbound": f"""
        SELECT r.report_date, setter_user_id, full_name AS setter_name, email AS setter_email,
               inbound_booked, inbound_taken, triage_set, strategy_calls_booked, strategy_calls_taken,
               offers_presented, total_sales, total_contract_value, total_cash_collected,
               {ratio('inbound_taken', 'inbound_booked')} AS show_rate,
               {ratio('triage_set', 'inbound_taken')} AS triage_set_rate,
               {ratio('offers_presented', 'strategy_calls_taken')} AS offer_rate,
               {ratio('total_sales', 'strategy_calls_taken')} AS sale_rate,
               {average('total_contract_value', 'total_sales')} AS average_order_value
        FROM inbound_rollup r LEFT JOIN users u ON r.setter_user_id = u.user_id""",
    "outbound_rollup": """
        SELECT CAST(initial_at AS DATE) AS report_date, setter_user_id, count(*) AS total_outbound_calls,
               count(DISTINCT lead_id) AS unique_leads_touched,
               count(*) FILTER (WHERE i.is_set) AS outbound_set,
               count(strategy_activity_id) AS strategy_calls_booked,
               count(*) FILTER (WHERE strategy_activity_id IS NOT NULL AND s.is_taken) AS total_closer_show,
               count(sale_activity_id) AS total_sales, sum(contract_value) AS total_contract_value,
               sum(cash_collected) AS total_cash_collected
        FROM fact f
        LEFT JOIN outcomes i ON i.canonical_field_name = 'prospecting_outcome' AND i.raw_value = f.initial_outcome
        LEFT JOIN outcomes s ON s.canonical_field_name = 'strategy_outcome' AND s.raw_value = f.strategy_outcome
        WHERE funnel_source = 'outbound' GROUP BY ALL""",
    "outbound": f"""
        SELECT r.report_date, setter_user_id, full_name AS setter_name, email AS setter_email,
               total_outbound_calls, unique_leads_touched, outbound_set, strategy_calls_booked,
               total_closer_show, total_sales, total_contract_value, total_cash_collected,
               {ratio('outbound_set', 'total_outbound_calls')} AS dial_to_set_rate,
               {ratio('total_closer_show', 'outbound_set')} AS set_to_show_rate,
               {ratio('total_sales', 'total_closer_show')} AS show_to_sale_rate,
               {average('total_contract_value', 'total_sales')} AS average_order_value
        FROM outbound_rollup r LEFT JOIN users u ON r.setter_user_id = u.user_id""",
    "closer_rollup": """
        SELECT CAST(strategy_at AS DATE) AS report_date, closer_user_id, count(*) AS calls_booked,
               count(*) FILTER (WHERE outcome_subcategory = 'admin_cancel') AS admin_cancellations,
               count(*) FILTER (WHERE outcome_subcategory = 'nurture_cancel') AS nurture_cancellations,
               count(*) FILTER (WHERE outcome_subcategory = 'not_interested_cancel') AS not_interested_cancellations,
               count(*) FILTER (WHERE outcome_subcategory = 'no_show') AS no_shows,
               count(*) FILTER (WHERE is_taken) AS shows,
               count(*) FILTER (WHERE outcome_category = 'lost') AS lost_deals,
               count(sale_activity_id) AS sales, sum(contract_value) AS total_contract_value,
               sum(cash_collected) AS total_cash_collected
        FROM fact f LEFT JOIN outcomes s
          ON s.canonical_field_name = 'strategy_outcome' AND s.raw_value = f.strategy_outcome
        WHERE strategy_activity_id IS NOT NULL GROUP BY ALL""",
    "closer": f"""
        SELECT r.report_date, closer_user_id, full_name AS closer_name, email AS closer_email,
               calls_booked, admin_cancellations, nurture_cancellations, not_interested_cancellations,
               no_shows, shows, lost_deals, sales, total_contract_value, total_cash_collected,
               {ratio('shows', 'calls_booked')} AS show_rate,
               {ratio('sales', 'shows')} AS show_to_sale_rate,
               {average('total_contract_value', 'sales')} AS average_contract_value
        FROM closer_rollup r LEFT JOIN users u ON r.closer_user_id = u.user_id""",
    "calls": """
        SELECT lead_funnel_id, lead_id, strategy_activity_id, CAST(strategy_at AS DATE) AS report_date,
               strategy_at, closer_user_id, objections_faced
        FROM fact WHERE strategy_activity_id IS NOT NULL AND objections_faced IS NOT NULL""",
    "mentions": """
        SELECT * EXCLUDE (objections_faced, label), trim(label) AS source_objection_value
        FROM (SELECT *, unnest(CASE WHEN json_type(objections_faced) = 'ARRAY'
                                    THEN json_extract_string(objections_faced, '$[*]') END) AS label FROM calls)
        WHERE trim(label) <> ''""",
    "objection_rows": """
        SELECT m.*, coalesce(o.normalized_objection_category, m.source_objection_value) AS objection_category
        FROM mentions m LEFT JOIN objection_map o
          ON lower(m.source_objection_value) = lower(o.source_objection_value) AND o.is_active""",
    "objections_report": f"""
        SELECT c.*, e.strategy_calls_evaluated,
               {ratio('distinct_strategy_call_count', 'strategy_calls_evaluated')} AS strategy_call_percentage
        FROM (SELECT report_date, objection_category, count(*) AS objection_count,
                     count(DISTINCT strategy_activity_id) AS distinct_strategy_call_count,
                     count(DISTINCT lead_id) AS distinct_lead_count
              FROM objection_rows GROUP BY ALL) c
        LEFT JOIN (SELECT report_date, count(DISTINCT strategy_activity_id) AS strategy_calls_evaluated
                   FROM calls GROUP BY ALL) e ON c.report_date = e.report_date""",
    "meta": f"SELECT p_partkey, {crm.duckdb_sql(crm.METADATA_TEXT)} AS t FROM part",
    "type_names": r"""
        SELECT DISTINCT custom_activity_type_id, custom_activity_type_name FROM (
          SELECT unnest(regexp_extract_all(t, '''id'': ''(actitype_[^'']+)''[^}]*?''name'': ''([^'']*)''', 1)) AS custom_activity_type_id,
                 unnest(regexp_extract_all(t, '''id'': ''(actitype_[^'']+)''[^}]*?''name'': ''([^'']*)''', 2)) AS custom_activity_type_name
          FROM meta)""",
    "field_names": r"""
        SELECT DISTINCT custom_field_id, custom_field_name, custom_field_type FROM (
          SELECT unnest(regexp_extract_all(t, '''id'': ''(cf_[^'']+)''[^}]*?''name'': ''([^'']*)''[^}]*?''type'': ''([^'']*)''', 1)) AS custom_field_id,
                 unnest(regexp_extract_all(t, '''id'': ''(cf_[^'']+)''[^}]*?''name'': ''([^'']*)''[^}]*?''type'': ''([^'']*)''', 2)) AS custom_field_name,
                 unnest(regexp_extract_all(t, '''id'': ''(cf_[^'']+)''[^}]*?''name'': ''([^'']*)''[^}]*?''type'': ''([^'']*)''', 3)) AS custom_field_type
          FROM meta)""",
    "field_rows": (
        "SELECT lead_id, activity_id, activity_at, custom_activity_type_id, custom_field_id, field_value FROM (\n"
        + "\nUNION ALL\n".join(
            f"SELECT lead_id, activity_id, activity_at, custom_activity_type_id, '{i}' AS custom_field_id, {c} AS field_value FROM custom"
            for c, i in crm.CUSTOM_KEYS.items()
        )
        + f"\nUNION ALL SELECT lead_id, activity_id, activity_at, custom_activity_type_id, '{crm.CONTRACT_FIELD}', "
        "CASE contract_text WHEN 'amount' THEN 'm' || contract_cents ELSE contract_text END FROM custom"
        f"\nUNION ALL SELECT lead_id, activity_id, activity_at, custom_activity_type_id, '{crm.CASH_FIELD}', "
        "'m' || cash_cents FROM custom"
        f"\nUNION ALL SELECT lead_id, activity_id, activity_at, custom_activity_type_id, '{crm.EXTRA_FIELD}', "
        "'m' || extra_cents FROM custom"
        f"\nUNION ALL SELECT lead_id, activity_id, activity_at, custom_activity_type_id, '{crm.OBJECTIONS_FIELD}', "
        "objections FROM custom)\nWHERE field_value IS NOT NULL"
    ),
}


def sql(body: str) -> str:
    """A query with the blocks it names, directly or through other blocks, in front."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    if not needed:
        return body
    blocks = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    body = body.strip()
    rest = f",\n{body[4:]}" if body.startswith("WITH") else f"\n{body}"
    return f"WITH {blocks}{rest}"
