"""The SQL each registered query is held to, for DuckDB.

Written from the meaning of each table, in plain form: interval conditions as they are said,
series joined by full outer joins, first rows by DISTINCT ON. ``RELATIONS`` are the named
steps; a statement starts with those it needs.
"""

from __future__ import annotations

import re

from fixture.extracts import AS_OF, BASE_TABLES, SQL, TEXTS
from tidewatch.plans.quality import RULES

TODAY = f"date '{AS_OF}'"

RELATIONS = {
    f"raw_{name}": text.format(**{t: t for t in BASE_TABLES}).strip() for name, text in SQL.items()
}

RELATIONS |= {
    "p": """
select partner_id, trim(partner_name) as partner_name, lower(trim(partner_type)) as partner_type
from raw_partners""",
    "m": """
select rm_id, partner_id, trim(name) as rm_name, lower(trim(email)) as rm_email from raw_rms""",
    "e": """
select entity_id, trim(entity_name) as entity_name, partner_id,
       lower(trim(entity_type)) as entity_type, lower(trim(kyc_status)) as kyc_status
from raw_entities""",
    "i": """
select investor_id, user_id, lower(trim(email)) as email, trim(full_name) as full_name, entity_id,
       trim(country) as country, created_at, relationship_manager_id
from raw_investors""",
    "k": """
select close_id, fund_id, trim(fund_name) as fund_name, partner_id, close_number,
       scheduled_close_date, lower(trim(close_status)) as close_status,
       total_committed_aum as total_committed_aum_gbp
from raw_closes""",
    "t": """
select ticket_id, lower(trim(requester_email)) as requester_email,
       trim(requester_name) as requester_name, trim(subject) as subject,
       lower(trim(status)) as status, lower(trim(priority)) as priority, created_at, resolved_at,
       tags as tags_raw,
       case when trim(partner_label) <> '' then trim(partner_label) end as partner_label
from raw_tickets""",
    "rich_i": """
select investor_id, user_id, email, full_name, country, created_at,
       i.entity_id, entity_name, entity_type, kyc_status,
       e.partner_id, partner_name, partner_type,
       relationship_manager_id, rm_name, rm_email,
       relationship_manager_id is not null as is_rm_managed
from i
left join e using (entity_id)
left join p on p.partner_id = e.partner_id
left join m on rm_id = relationship_manager_id""",
    "rich_m": """
select rm_id, rm_name, rm_email, m.partner_id, partner_name, partner_type
from m left join p using (partner_id)""",
    "rich_e": """
select entity_id, entity_name, entity_type, kyc_status, e.partner_id, partner_name, partner_type
from e left join p using (partner_id)""",
    "rich_k": f"""
select close_id, fund_id, fund_name, close_number, scheduled_close_date, close_status,
       total_committed_aum_gbp, k.partner_id, partner_name, partner_type,
       cast(scheduled_close_date - (isodow(scheduled_close_date) - 1) * interval 1 day as date)
         as close_week,
       make_date(year(scheduled_close_date), month(scheduled_close_date), 1) as close_month,
       close_status = 'upcoming' as is_upcoming,
       close_status = 'upcoming' and scheduled_close_date < {TODAY} as is_stale_upcoming
from k left join p using (partner_id)""",
    "first_i": """
select chosen.*, n as investor_match_count
from (select distinct on (email) email, investor_id, partner_id as investor_partner_id
      from rich_i where email is not null
      order by email, created_at nulls last, investor_id) as chosen
join (select email, count(*) as n from rich_i group by email) as sizes using (email)""",
    "first_m": """
select chosen.*, n as rm_match_count
from (select distinct on (rm_email) rm_email, rm_id, partner_id as rm_partner_id
      from rich_m where rm_email is not null order by rm_email, rm_id) as chosen
join (select rm_email, count(*) as n from rich_m group by rm_email) as sizes using (rm_email)""",
    "first_label": """
select distinct on (label_norm) label_norm, partner_id as label_partner_id
from (select lower(trim(label_raw)) as label_norm, label_raw, partner_id from raw_label_synonyms)
order by label_norm, label_raw, partner_id""",
    "known": """
select t.*, investor_id, investor_partner_id, investor_match_count,
       rm_id, rm_partner_id, rm_match_count, label_partner_id,
       case when investor_id is not null then 'investor'
            when rm_id is not null then 'relationship_manager'
            when contains(requester_email, '@corp.') then 'internal'
            else 'unknown' end as requester_type
from t
left join first_i on email = requester_email
left join first_m on rm_email = requester_email
left join first_label on label_norm = lower(partner_label)""",
    "solved": """
select *,
       investor_id is not null as matched_investor,
       rm_id is not null as matched_rm,
       investor_id is not null and rm_id is not null as requester_matched_both,
       ends_with(requester_email, '@corp.com') as is_corp_com,
       ends_with(requester_email, '@corp.io') as is_corp_io,
       case requester_type when 'investor' then coalesce(investor_partner_id, label_partner_id)
            when 'relationship_manager' then coalesce(rm_partner_id, label_partner_id)
            else label_partner_id end as partner_id,
       case requester_type when 'investor' then 'investor_email_match'
            when 'relationship_manager' then 'rm_email_match'
            else case when label_partner_id is null then 'unresolved'
                      else 'partner_label_fallback' end end as partner_attribution_method
from known""",
    "fact": """
select ticket_id, investor_id, rm_id, partner_id, requester_type, requester_email, requester_name,
       partner_attribution_method, requester_matched_both,
       investor_match_count is not null and investor_match_count > 1 as investor_email_is_ambiguous,
       rm_match_count is not null and rm_match_count > 1 as rm_email_is_ambiguous,
       subject, status, priority, partner_label, created_at, resolved_at,
       cast(created_at as date) as created_date,
       cast(date_trunc('week', created_at) as date) as created_week,
       cast(date_trunc('month', created_at) as date) as created_month,
       resolved_at is not null as is_resolved,
       status = 'open' or status = 'pending' as is_open,
       date_diff('microsecond', created_at, resolved_at) / 3.6e9 as resolution_hours
from solved""",
    "tag": """
select * from (
  select ticket_id, investor_id, rm_id, partner_id, requester_type, created_at,
         lower(trim(unnest(string_split(tags_raw, ',')))) as tag
  from solved)
where tag <> ''""",
    "summary": """
select investor_id, full_name, email, country, entity_id, entity_name, entity_type, kyc_status,
       d.partner_id, partner_name, partner_type, is_rm_managed,
       count(ticket_id) as ticket_count,
       count(case when is_resolved then 1 end) as resolved_count,
       count(case when is_open then 1 end) as open_count,
       count(case when priority = 'urgent' then 1 end) as urgent_count,
       count(case when priority = 'high' then 1 end) as high_count,
       avg(resolution_hours) as avg_resolution_hours,
       quantile_cont(resolution_hours, 0.5) as median_resolution_hours,
       min(f.created_at) as first_ticket_at,
       max(f.created_at) as last_ticket_at
from rich_i as d
left join (select * exclude (requester_email, partner_id) from fact
           where requester_type = 'investor') as f using (investor_id)
group by all""",
    "per_week": """
select week_start,
       coalesce(tickets_created, 0) as tickets_created,
       coalesce(tickets_high_urgent, 0) as tickets_high_urgent,
       coalesce(tickets_resolved, 0) as tickets_resolved,
       coalesce(closes_scheduled, 0) as closes_scheduled,
       coalesce(closes_completed, 0) as closes_completed,
       coalesce(closes_upcoming, 0) as closes_upcoming,
       coalesce(committed_aum_closing_gbp, 0) as committed_aum_closing_gbp
from (select distinct week_start from (
        select created_week as week_start from fact
        union all select cast(date_trunc('week', resolved_at) as date) from fact where is_resolved
        union all select close_week from rich_k)) as weeks
left join (select created_week as week_start, count(*) as tickets_created,
                  count(case when priority in ('high', 'urgent') then 1 end) as tickets_high_urgent
           from fact group by all) as a using (week_start)
left join (select cast(date_trunc('week', resolved_at) as date) as week_start,
                  count(*) as tickets_resolved
           from fact where is_resolved group by all) as b using (week_start)
left join (select close_week as week_start, count(*) as closes_scheduled,
                  count(case when close_status = 'completed' then 1 end) as closes_completed,
                  count(case when close_status = 'upcoming' then 1 end) as closes_upcoming,
                  cast(sum(total_committed_aum_gbp) as bigint) as committed_aum_closing_gbp
           from rich_k group by all) as c using (week_start)""",
    "per_partner_week": """
select cells.partner_id, partner_name, partner_type, cells.week_start,
       coalesce(tickets_created, 0) as tickets_created,
       coalesce(tickets_high_urgent, 0) as tickets_high_urgent,
       coalesce(investor_tickets, 0) as investor_tickets,
       coalesce(rm_tickets, 0) as rm_tickets,
       coalesce(closes_scheduled, 0) as closes_scheduled,
       coalesce(closes_completed, 0) as closes_completed,
       coalesce(closes_upcoming, 0) as closes_upcoming,
       coalesce(committed_aum_gbp, 0) as committed_aum_gbp
from (select distinct partner_id, week_start from (
        select partner_id, created_week as week_start from fact where partner_id is not null
        union all select partner_id, close_week from rich_k)) as cells
left join (select partner_id, created_week as week_start, count(*) as tickets_created,
                  count(case when priority in ('high', 'urgent') then 1 end) as tickets_high_urgent,
                  count(case when requester_type = 'investor' then 1 end) as investor_tickets,
                  count(case when requester_type = 'relationship_manager' then 1 end) as rm_tickets
           from fact group by all) as a
  on a.partner_id = cells.partner_id and a.week_start = cells.week_start
left join (select partner_id, close_week as week_start, count(*) as closes_scheduled,
                  count(case when close_status = 'completed' then 1 end) as closes_completed,
                  count(case when close_status = 'upcoming' then 1 end) as closes_upcoming,
                  cast(sum(total_committed_aum_gbp) as bigint) as committed_aum_gbp
           from rich_k group by all) as c
  on c.partner_id = cells.partner_id and c.week_start = cells.week_start
left join p on p.partner_id = cells.partner_id""",
    "themed": """
select theme, theme_label, theme_sort_order, partner_id,
       cast(date_trunc('week', created_at) as date) as week_start,
       cast(date_trunc('month', created_at) as date) as month_start,
       requester_type, count(distinct ticket_id) as ticket_count
from tag join raw_tag_themes using (tag)
group by all""",
    "health": """
select created_week as week_start, count(*) as total_tickets,
       count(case when requester_type = 'investor' then 1 end) as investor_tickets,
       count(case when requester_type = 'relationship_manager' then 1 end) as rm_tickets,
       count(case when requester_type = 'internal' then 1 end) as internal_tickets,
       count(case when requester_type = 'unknown' then 1 end) as unknown_tickets,
       count(case when partner_attribution_method = 'investor_email_match' then 1 end) as attr_investor_email,
       count(case when partner_attribution_method = 'rm_email_match' then 1 end) as attr_rm_email,
       count(case when partner_attribution_method = 'partner_label_fallback' then 1 end) as attr_label_fallback,
       count(case when partner_attribution_method = 'unresolved' then 1 end) as attr_unresolved,
       count(case when investor_email_is_ambiguous then 1 end) as ambiguous_investor_email_count,
       count(case when rm_email_is_ambiguous then 1 end) as ambiguous_rm_email_count,
       round(100.0 * attr_unresolved / total_tickets, 2) as unresolved_rate_pct,
       round(100.0 * attr_label_fallback / total_tickets, 2) as fallback_rate_pct,
       round(100.0 * unknown_tickets / total_tickets, 2) as unknown_requester_rate_pct,
       round(100.0 * internal_tickets / total_tickets, 2) as internal_requester_rate_pct,
       (select count(*) from rich_k where is_stale_upcoming) as stale_upcoming_close_count
from fact group by created_week""",
}


def _near(days: int) -> str:
    """Every close with every ticket of its partner that lies near it."""
    return f"""
select close_id, fund_id, fund_name, close_number, c.partner_id, partner_name,
       scheduled_close_date, close_status, total_committed_aum_gbp,
       count(ticket_id) as tickets_in_window,
       count(case when created_date < scheduled_close_date then ticket_id end)
         as tickets_before_close,
       count(case when created_date >= scheduled_close_date then ticket_id end)
         as tickets_on_or_after_close,
       count(case when priority in ('high', 'urgent') then ticket_id end) as tickets_high_urgent
from rich_k as c
left join (select ticket_id, partner_id, created_date, priority from fact) as f
  on f.partner_id = c.partner_id
 and abs(date_diff('day', created_date, scheduled_close_date)) <= {days}
group by all"""


RELATIONS |= {
    "near": _near(14),
    "past": """
select partner_id, count(*) as closes, avg(tickets_in_window) as mean,
       min(tickets_in_window) as least, max(tickets_in_window) as most,
       avg(tickets_high_urgent) as urgent_mean
from near where close_status = 'completed' group by partner_id""",
    "merged": """
select * exclude (resolved_at),
       case when created_at >= day or resolved_at <= timestamp '1999-06-30' then resolved_at end
         as resolved_at
from fact, (select max(cast(created_at as date)) - 3 as day from fact
            where created_at <= timestamp '1999-06-30') as cut""",
    "texts": """
select *, try_cast(ticket_id as bigint) is null as odd_id,
       trim(created_on) <> '' and try_cast(created_on as date) is null as odd_date,
       trim(minutes) <> '' and try_cast(minutes as integer) is null as odd_minutes
from (""" + TEXTS.format(raw_tickets="raw_tickets") + ")",
    "live": "select * from rich_k where is_upcoming and not is_stale_upcoming",
    "forecast": """
select close_id, fund_id, fund_name, close_number, live.partner_id, partner_name, partner_type,
       scheduled_close_date, total_committed_aum_gbp,
       cast(scheduled_close_date - interval 14 day as date) as pressure_window_start,
       cast(scheduled_close_date + interval 14 day as date) as pressure_window_end,
       closes as historical_close_count, round(mean, 1) as avg_tickets_per_close,
       least as min_tickets_observed, most as max_tickets_observed,
       round(urgent_mean, 1) as avg_high_urgent_per_close,
       round(mean, 0) as expected_tickets, round(urgent_mean, 0) as expected_high_urgent_tickets,
       closes is null as no_historical_data, closes < 3 as low_sample_warning
from live left join past on past.partner_id = live.partner_id""",
}


def statement(query: str) -> str:
    """``query`` preceded by the relations it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(RELATIONS[name])
                needed.append(name)

    visit(query)
    steps = ",\n".join(f"{name} as ({RELATIONS[name].strip()})" for name in needed)
    return f"with {steps}\n{query}" if steps else query


def _whole(name: str) -> str:
    return f"select * from {name}"


QUERIES = {
    "stage_tickets": _whole("t"),
    "stage_entities": _whole("e"),
    "stage_closes": _whole("k"),
    "stage_investors": _whole("i"),
    "stage_partners": _whole("p"),
    "stage_managers": _whole("m"),
    "investors_enriched": _whole("rich_i"),
    "managers_enriched": _whole("rich_m"),
    "investor_by_email": _whole("first_i"),
    "manager_by_email": _whole("first_m"),
    "identity_lookup": """
select coalesce(email, rm_email) as email, investor_id, investor_partner_id, investor_match_count,
       rm_id, rm_partner_id, rm_match_count
from first_i full join first_m on email = rm_email""",
    "label_lookup": _whole("first_label"),
    "resolve_requesters": """
select * exclude (label_partner_id, partner_id, partner_attribution_method) from solved""",
    "attribution": _whole("solved"),
    "dim_partner": _whole("p"),
    "dim_manager": _whole("rich_m"),
    "dim_entity": _whole("rich_e"),
    "dim_investor": _whole("rich_i"),
    "dim_close": _whole("rich_k"),
    "ticket_fact": _whole("fact"),
    "ticket_tags": _whole("tag"),
    "investor_summary": _whole("summary"),
    "team_pressure_weekly": _whole("per_week"),
    "partner_pressure_weekly": _whole("per_partner_week"),
    "close_pressure_14": _whole("near"),
    "close_pressure_21": _near(21),
    "staffing_forecast": _whole("forecast"),
    "load_estimate": """
select partner_id, upcoming_closes, closes as completed_close_count,
       round(mean, 1) as avg_tickets_per_close,
       round(mean * upcoming_closes, 1) as expected_load
from (select partner_id, count(*) as upcoming_closes from live group by partner_id) as ahead
left join past using (partner_id)""",
    "theme_summary": _whole("themed"),
    "attribution_health": _whole("health"),
    "incremental_merge": """
select ticket_id, requester_type, partner_id, partner_attribution_method, created_at,
       created_month, status,
       case when created_at >= day or resolved_at <= timestamp '1999-06-30' then resolved_at end
         as resolved_at,
       case when created_at >= day or resolved_at <= timestamp '1999-06-30' then is_resolved
            else false end as is_resolved,
       case when created_at >= day or resolved_at <= timestamp '1999-06-30' then resolution_hours
            end as resolution_hours
from fact, (select max(cast(created_at as date)) - 3 as day from fact
            where created_at <= timestamp '1999-06-30') as cut""",
    "close_ticket_pairs": """
select close_id, k.partner_id, scheduled_close_date, ticket_id, cast(created_at as date) as created_date,
       cast(date_diff('day', scheduled_close_date, cast(created_at as date)) as integer) as days_after
from rich_k as k join fact on fact.partner_id = k.partner_id
 and abs(date_diff('day', scheduled_close_date, cast(created_at as date))) <= 14""",
    "close_ticket_measures": """
select k.partner_id, scheduled_close_date, count(*) as tickets,
       count(distinct requester_email) as requesters,
       quantile_cont(resolution_hours, 0.5) as median_hours
from (select distinct partner_id, scheduled_close_date from rich_k) as k
join fact on fact.partner_id = k.partner_id
 and abs(date_diff('day', scheduled_close_date, cast(created_at as date))) <= 14
group by all""",
    "schema_sync": """
select ticket_id, partner_id, created_at, cast(null as varchar) as channel from fact""",
    "kept_team_weekly": """
select week_start, coalesce(created, 0) as tickets_created, coalesce(urgent, 0) as tickets_high_urgent,
       coalesce(resolved, 0) as tickets_resolved, coalesce(closes, 0) as closes_scheduled,
       coalesce(completed, 0) as closes_completed, coalesce(upcoming, 0) as closes_upcoming,
       coalesce(aum, 0) as committed_aum_closing_gbp
from (select created_week as week_start, count(*) as created,
             count(case when priority in ('high', 'urgent') then 1 end) as urgent
      from merged group by all) as a
full join (select cast(date_trunc('week', resolved_at) as date) as week_start, count(*) as resolved
           from merged where resolved_at is not null group by all) as b using (week_start)
full join (select close_week as week_start, count(*) as closes,
                  count(case when close_status = 'completed' then 1 end) as completed,
                  count(case when close_status = 'upcoming' then 1 end) as upcoming,
                  cast(sum(total_committed_aum_gbp) as bigint) as aum
           from rich_k where close_week is not null group by all) as c using (week_start)
union all
select null, 0, 0, 0, 0, 0, 0, 0
where (select count(*) from rich_k where close_week is null) > 0""",
    "kept_partner_weekly": _whole("per_partner_week"),
    "sketched_investors": """
select investor_id, count(*) as row_count, quantile_disc(resolution_hours, 0.5) as median_hours
from fact
where requester_type = 'investor' and investor_id is not null
  and created_at >= date '1996-01-01' and created_at < date '1999-01-01'
group by investor_id""",
    "sketched_themes": """
select theme, count(*) as row_count, count(distinct investor_id) as investors,
       count(distinct partner_id) as partners
from tag join raw_tag_themes using (tag)
where created_at >= date '1996-01-01' and created_at < date '1999-01-01'
group by theme""",
    "kept_themes": _whole("themed"),
    "kept_health": _whole("health"),
    "lenient_good": """
select try_cast(ticket_id as bigint) as ticket_id, requester_email,
       try_cast(nullif(trim(created_on), '') as date) as created_on,
       try_cast(nullif(trim(minutes), '') as integer) as minutes
from texts where not odd_id and not odd_date and not odd_minutes""",
    "lenient_quarantine": """
select 'ticket_id' as column_name, ticket_id as value, 'not a bigint' as reason from texts where odd_id
union all
select 'created_on', created_on, 'not a date' from texts where odd_date
union all
select 'minutes', minutes, 'not a int' from texts where odd_minutes""",
    "weekly_from_stream": """
select week_start, event_type, count(*) as events
from (select cast(date_trunc('week', ts) as date) as week_start, event_type from events) as weeks
where week_start + interval 7 day <= (select max(ts) from events) - interval 3 day
group by week_start, event_type""",
    "tags_by_sql": """
select cast(date_trunc('week', created_at) as date) as week_start,
       cast(date_trunc('month', created_at) as date) as month_start,
       lower(trim(piece)) as tag, count(*) as pieces,
       round(sum(date_diff('microsecond', created_at, resolved_at) / 3.6e9), 3) as hours,
       cast(min(cast(created_at as date)) + interval 14 day as date) as due,
       cast(max(cast(created_at as date)) - interval 3 day as date) as since,
       count(resolved_at) as resolved,
       round(100.0 * count(resolved_at) / count(*), 2) as resolved_pct
from (select *, unnest(string_split(tags, ',')) as piece from raw_tickets)
group by all""",
    "check_unique": "select email, count(*) as n from i group by email having n > 1",
    "check_not_null": "select * from rich_i where created_at is null",
    "check_accepted": """
select entity_type, count(*) as n from e
where entity_type not in ('furniture', 'household') group by all""",
    "check_orphans": """
select partner_id, count(*) as n from k
where partner_id is not null and partner_id not in (select partner_id from p) group by all""",
    "check_key_overlap": """
select email, count(*) as n from rich_i where email in (select rm_email from rich_m)
group by email""",
    "profile_tickets": " union all ".join(
        f"""
select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as nulls,
       count(distinct {c}) as distinct_values,
       round(100.0 * (count(*) - count({c})) / count(*), 2) as null_rate_pct
from t"""
        for c in ("requester_email", "status", "priority", "resolved_at", "tags_raw", "partner_label")
    ),
    "close_order_anomaly": """
select a.fund_id, a.close_number, min(a.scheduled_close_date) as first_date, latest_lower_date
from k as a join (
  select b.fund_id, b.close_number, max(c.scheduled_close_date) as latest_lower_date
  from (select distinct fund_id, close_number from k) as b
  join k as c on c.fund_id = b.fund_id and c.close_number < b.close_number
  group by all) as lower_dates on lower_dates.fund_id = a.fund_id
                              and lower_dates.close_number = a.close_number
group by all having first_date < latest_lower_date""",
    "build_synonyms": """
select label_raw, case when partners = 1 then partner_id end as partner_id, partners,
       case when partners = 1 then 'mapped' when partners > 1 then 'ambiguous'
            else 'unmapped' end as outcome
from (select label_raw, min(partner_id) as partner_id, count(distinct partner_id) as partners
      from (select distinct partner_label as label_raw from raw_tickets
            where partner_label is not null) as labels
      left join (select partner_id, lower(partner_name) as keyword from p) as words
        on contains(lower(trim(label_raw)), keyword)
      group by label_raw)""",
    "aq_01": """
select investor_id, full_name, partner_name, ticket_count, open_count, urgent_count from summary
where ticket_count > 0 order by open_count desc, ticket_count desc, investor_id limit 10""",
    "aq_02": """
select investor_id, full_name, partner_name, ticket_count,
       round(median_resolution_hours / 24, 1) as median_days
from summary where median_resolution_hours > 168""",
    "aq_03": """
select partner_name, count(*) as investors_never_raised_ticket from summary
where ticket_count = 0 group by partner_name""",
    "aq_04": """
select theme_label, cast(sum(ticket_count) as bigint) as tickets from themed
where week_start >= date '1999-01-01' group by theme_label, theme_sort_order""",
    "aq_05": f"""
select theme_label,
       cast(sum(case when week_start >= {TODAY} - 90 then ticket_count end) as bigint) as recent,
       cast(sum(case when week_start >= {TODAY} - 180 and week_start < {TODAY} - 90
                     then ticket_count end) as bigint) as prior
from themed group by theme_label, theme_sort_order""",
    "aq_06": f"""
select close_id, scheduled_close_date, fund_name, partner_name, expected_tickets,
       min_tickets_observed, max_tickets_observed, no_historical_data, low_sample_warning
from forecast where pressure_window_end >= {TODAY}""",
    "aq_07": f"""
select partner_name, count(*) as closes_upcoming, sum(expected_tickets) as total_expected_tickets
from forecast where scheduled_close_date between {TODAY} and {TODAY} + 90 group by partner_name""",
    "aq_08": f"""
select week_start, tickets_created, tickets_high_urgent, closes_scheduled,
       committed_aum_closing_gbp
from per_week where week_start >= {TODAY} - 180""",
    "aq_09": """
select week_start, tickets_created, tickets_high_urgent, closes_scheduled from per_week
order by tickets_high_urgent desc, week_start limit 10""",
    "aq_10": f"""
select partner_name, cast(sum(tickets_created) as bigint) as tickets from per_partner_week
where week_start >= {TODAY} - 28 group by partner_name""",
    "aq_11": """
select close_id, fund_name, partner_name, scheduled_close_date, tickets_in_window,
       tickets_high_urgent
from near where close_status = 'completed' order by tickets_in_window desc, close_id limit 20""",
    "aq_12": """
select week_start, unresolved_rate_pct, fallback_rate_pct, unknown_requester_rate_pct,
       internal_requester_rate_pct
from health order by week_start desc nulls last limit 12""",
    "aq_13": f"""
select ticket_id, requester_email, requester_type, partner_id, priority, created_at from fact
where is_open and priority in ('high', 'urgent')
  and created_week = cast(date_trunc('week', {TODAY}) as date)""",
    "aq_14": f"""
select partner_name, count(*) as tickets from fact join p using (partner_id)
where created_at >= {TODAY} - 90 group by partner_name""",
    "event_hours": """
select a.event_id, b.event_id as next_event_id,
       date_diff('microsecond', a.ts, b.ts) / 3.6e9 as hours_to_next
from events as a left join events as b on b.event_id = a.event_id + 1""",
    "event_weekly": """
select cast(date_trunc('week', ts) as date) as week_start,
       cast(date_trunc('month', ts) as date) as month_start, event_type, count(*) as events
from events group by all""",
}

# names of the checked tables in this file
_CHECKED = {
    "stg_partners": "p",
    "stg_relationship_managers": "m",
    "stg_entities": "e",
    "stg_investors": "i",
    "stg_fund_closes": "k",
    "stg_tickets": "t",
    "int_investors": "rich_i",
    "int_relationship_managers": "rich_m",
    "int_tickets": "solved",
    "dim_partner": "p",
    "dim_relationship_manager": "rich_m",
    "dim_entity": "rich_e",
    "dim_investor": "rich_i",
    "dim_fund_close": "rich_k",
    "fct_tickets": "fact",
    "mart_investor_ticket_summary": "summary",
    "mart_is_pressure_weekly": "per_week",
    "mart_attribution_health": "health",
    "mart_staffing_forecast": "forecast",
    "mart_close_ticket_pressure": "near",
}


def _check_lines() -> list[str]:
    def line(check: str, table: str, column: str, severity: str, failing: str) -> str:
        return f"""
select '{check}' as check_name, '{table}' as table_name, '{column}' as column_name,
       '{severity}' as severity, n as failures, n = 0 as passed from (select {failing})"""

    lines = []
    for table, rules in RULES.items():
        source, key = _CHECKED[table], rules.key
        lines.append(
            line(
                *("unique", table, key, "error"),
                f"count(*) as n from (select {key} from {source} where {key} is not null "
                f"group by 1 having count(*) > 1)",
            )
        )
        for column in (key, *rules.not_null):
            nulls = f"count(*) as n from {source} where {column} is null"
            lines.append(line("not_null", table, column, "error", nulls))
        for column, values in rules.accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            severity = "error" if column in rules.strict else "warn"
            odd = f"count(distinct {column}) as n from {source} where {column} not in ({listed})"
            lines.append(line("accepted_values", table, column, severity, odd))
        for ref in rules.references:
            orphans = (
                f"count(*) as n from {source} where {ref.column} is not null and {ref.column} "
                f"not in (select {ref.parent_column} from {_CHECKED[ref.parent]})"
            )
            lines.append(line("relationships", table, ref.column, "warn", orphans))
    shared = "count(*) as n from rich_i where email in (select rm_email from rich_m)"
    lines.append(line("no_shared_email", "dim_investor", "email", "error", shared))
    return lines


QUERIES["check_report"] = " union all ".join(_check_lines())

_PUBLISHED = {n: _CHECKED[n] for n in _CHECKED if n.startswith(("dim_", "fct_", "mart_"))}
_PUBLISHED |= {
    "fct_ticket_tags": "tag",
    "mart_partner_pressure_weekly": "per_partner_week",
    "mart_theme_ticket_summary": "themed",
}
QUERIES["released_tables"] = " union all ".join(
    [
        f"select '{name}' as table_name, count(*) as row_count from {source}"
        for name, source in _PUBLISHED.items()
    ]
    + [f"select 'data_checks' as table_name, {len(_check_lines())}::bigint as row_count"]
)


QUERIES["clustered_merge"] = QUERIES["incremental_merge"]


def oracle_sql() -> dict[str, str]:
    return {name: statement(query.strip()) for name, query in QUERIES.items()}
