"""The registered queries: each operator, mart and report on the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixture.extracts import BASE_SCHEMAS, TEXTS, base_table, warehouse
from tidewatch import Warehouse
from tidewatch.functions import hours_between, month_start, week_start
from tidewatch.operators import checks, sketches
from tidewatch.operators.incremental import lookback_filter, merge_by_key, merge_into_table, sync_schema
from tidewatch.operators.pairs import measures_around, pairs_around
from tidewatch.operators.profile import close_order_anomalies, profile
from tidewatch.operators.synonyms import build_synonyms, distinctive_keywords
from tidewatch.plans import analyst, kept_marts, sql_functions
from tidewatch.sources import Releases, lenient, shared_folder, write_clustered
from tidewatch.streaming.weekly import closed_weeks, count_weeks

Query = Callable[[SparkSession, str], DataFrame]

LOADED_UNTIL = date(1999, 6, 30)
MERGED = [
    *("ticket_id", "requester_type", "partner_id", "partner_attribution_method"),
    *("created_at", "created_month", "status", "resolved_at", "is_resolved", "resolution_hours"),
]
PROFILED = ["requester_email", "status", "priority", "resolved_at", "tags_raw", "partner_label"]


def _on(build: Callable[[Warehouse], DataFrame], **settings) -> Query:
    return lambda spark, sf_dir: build(warehouse(spark, sf_dir, **settings))


def loaded_and_batch(model: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The fact as loaded on a day in the past, and what a refresh after the last day merges into it."""
    until = F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    fact = model.ticket_fact.select(*MERGED)
    known = F.col("resolved_at") <= until
    loaded = fact.filter(F.col("created_at") <= until).withColumns(
        {
            "resolved_at": F.when(known, F.col("resolved_at")),
            "is_resolved": F.coalesce(known, F.lit(False)),
            "resolution_hours": F.when(known, F.col("resolution_hours")),
        }
    )
    days = model.tickets.filter(F.col("created_at") <= until).select("created_at")
    recent = lookback_filter(model.tickets, days, "created_at", model.settings.lookback_days)
    batch = Warehouse(model.raw, model.settings)
    batch.tickets = recent
    return loaded, batch.ticket_fact.select(*MERGED)


def incremental_merge(model: Warehouse) -> DataFrame:
    """The fact as loaded on a day in the past, then brought up to date by lookback and merge."""
    return merge_by_key(*loaded_and_batch(model), "ticket_id")


def clustered_merge(model: Warehouse) -> DataFrame:
    """The same merge into a stored fact that is clustered by ticket."""
    spark = model.raw["tickets"].sparkSession
    name = f"clustered_{uuid4().hex}"
    loaded, batch = loaded_and_batch(model)
    write_clustered(
        loaded, name, "ticket_id", "created_month", buckets=16, path=f"{shared_folder(spark)}/{name}"
    )
    merge_into_table(batch, name, "ticket_id", "created_month")
    return spark.table(name)


def near_pairs(model: Warehouse) -> DataFrame:
    """Every close with every ticket of its partner within the window around it."""
    closes = model.dim_close.select("close_id", "partner_id", "scheduled_close_date")
    tickets = model.ticket_fact.select("ticket_id", "partner_id", "created_date")
    return pairs_around(
        closes, tickets, "partner_id", "scheduled_close_date", "created_date",
        model.settings.window_days, "close_id", "ticket_id",
    )


def near_measures(model: Warehouse) -> DataFrame:
    """Per partner and close date: median duration and distinct requesters of the tickets near it."""
    return measures_around(
        model.dim_close, model.ticket_fact, "partner_id", "scheduled_close_date", "created_date",
        model.settings.window_days, "ticket_id", "resolution_hours", "requester_email",
    ).withColumnsRenamed(
        {"events": "tickets", "distinct_values": "requesters", "median_value": "median_hours"}
    )


def kept(mart: str) -> Callable[[Warehouse], DataFrame]:
    """A mart that followed the merge of ``incremental_merge``, from its state before and the change log."""

    def followed(model: Warehouse) -> DataFrame:
        until = F.lit(LOADED_UNTIL).cast("timestamp_ntz")
        known = F.col("resolved_at") <= until
        fact = model.ticket_fact.filter(F.col("created_at") <= until).withColumns(
            {
                "resolved_at": F.when(known, F.col("resolved_at")),
                "is_resolved": F.coalesce(known, F.lit(False)),
                "resolution_hours": F.when(known, F.col("resolution_hours")),
            }
        )
        bridge = model.ticket_tags.filter(F.col("created_at") <= until)
        days = model.tickets.filter(F.col("created_at") <= until).select("created_at")
        recent = lookback_filter(model.tickets, days, "created_at", model.settings.lookback_days)
        new = Warehouse(model.raw, model.settings)
        new.tickets = recent
        loaded = {kept_marts.FACT: fact, kept_marts.BRIDGE: bridge}
        batch = {kept_marts.FACT: new.ticket_fact, kept_marts.BRIDGE: new.ticket_tags}
        return kept_marts.marts_of(kept_marts.states_after(model, loaded, batch), model)[mart]

    return followed


def released(model: Warehouse) -> DataFrame:
    """Rows of every table that readers see after a release, with the release's own report."""
    spark = model.raw["tickets"].sparkSession
    root = f"{shared_folder(spark)}/releases-{uuid4().hex}"
    model.release(root, blocking=())  # these extracts share addresses, which is an error
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in sorted(Releases(spark, root).tables().items())
    ]
    return reduce(DataFrame.unionByName, counts)


TYPED = "ticket_id bigint not null, requester_email string, created_on date, minutes int"


def lenient_load(model: Warehouse) -> lenient.Loaded:
    spark = model.raw["tickets"].sparkSession
    texts = spark.sql(TEXTS, raw_tickets=model.raw["tickets"])
    return lenient.load(texts, T.StructType.fromDDL(TYPED), max_bad_share=0.2)


def weekly_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per closed week and kind, counted by a stream that has come to the end of the table."""
    events = spark.readStream.schema(BASE_SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet*")
    folder = f"{shared_folder(spark)}/weeks-{uuid4().hex}"
    count_weeks(
        closed_weeks(events, "ts", by=("event_type",), delay="3 days"),
        f"{folder}/rows", f"{folder}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").withColumnRenamed("rows", "events")


def tags_by_sql(model: Warehouse) -> DataFrame:
    """The session's SQL functions in one statement on the registered tables."""
    spark = model.raw["tickets"].sparkSession
    sql_functions.register(spark)
    return spark.sql(
        """
        select week_start(created_at) as week_start, month_start(created_at) as month_start,
               norm_key(piece) as tag, count(*) as pieces,
               round(sum(datediff_hours(created_at, resolved_at)), 3) as hours,
               min(date_add_days(created_on, 14)) as due, max(date_sub_days(created_on, 3)) as since,
               cast_int64(count(resolved_at)) as resolved,
               rate_pct(count(resolved_at), count(*)) as resolved_pct
        from (select *, cast(created_at as date) as created_on from {tickets}) as t,
             lateral unnest_split(tags, ',')
        group by all
        """,
        tickets=model.raw["tickets"],
    )


def sketched(rows: DataFrame, key: str, since: date, until: date, **columns) -> DataFrame:
    """Answers over a period from sketches that were stored per month."""
    path = f"{shared_folder(rows.sparkSession)}/sketches-{uuid4().hex}"
    names = {kind: list(asked) for kind, asked in columns.items()}
    sketches.write_months(sketches.monthly(rows, [key], "created_month", **names), path, "created_month")
    stored = rows.sparkSession.read.parquet(path)
    quantiles = {name: (column, 0.5) for column, name in columns.get("quantiles", {}).items()}
    distinct = {name: column for column, name in columns.get("distinct", {}).items()}
    return sketches.over_period(
        stored, [key], "created_month", since, until, quantiles=quantiles, distinct=distinct
    )


def sketched_investors(model: Warehouse) -> DataFrame:
    own = model.ticket_fact.filter("requester_type = 'investor' and investor_id is not null")
    median = {"resolution_hours": "median_hours"}
    return sketched(own, "investor_id", date(1996, 1, 1), date(1999, 1, 1), quantiles=median)


def sketched_themes(model: Warehouse) -> DataFrame:
    tagged = model.ticket_tags.join(model.raw["tag_themes"], "tag")
    tagged = tagged.withColumn("created_month", month_start("created_at"))
    counted = {"investor_id": "investors", "partner_id": "partners"}
    return sketched(tagged, "theme", date(1996, 1, 1), date(1999, 1, 1), distinct=counted)


def schema_sync(model: Warehouse) -> DataFrame:
    wanted = T.StructType(
        [
            T.StructField("ticket_id", T.LongType()),
            T.StructField("partner_id", T.StringType()),
            T.StructField("created_at", T.TimestampNTZType()),
            T.StructField("channel", T.StringType()),
        ]
    )
    return sync_schema(model.ticket_fact, wanted)


def synonyms(model: Warehouse) -> DataFrame:
    labels = model.raw["tickets"].select(F.col("partner_label").alias("label_raw"))
    return build_synonyms(labels, distinctive_keywords(model.partners))


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from each event to the one with the next id."""
    events = base_table(spark, sf_dir, "events")
    following = events.select(
        (F.col("event_id") - 1).alias("event_id"),
        F.col("event_id").alias("next_event_id"),
        F.col("ts").alias("next_ts"),
    )
    return events.join(following, "event_id", "left").select(
        "event_id", "next_event_id", hours_between("ts", "next_ts").alias("hours_to_next")
    )


def event_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = base_table(spark, sf_dir, "events")
    weeks = events.groupBy(
        week_start("ts").alias("week_start"), month_start("ts").alias("month_start"), "event_type"
    )
    return weeks.agg(F.count("*").alias("events"))


QUERIES: dict[str, Query] = {
    "stage_tickets": _on(lambda w: w.tickets),
    "stage_entities": _on(lambda w: w.entities),
    "stage_closes": _on(lambda w: w.closes),
    "stage_investors": _on(lambda w: w.investors),
    "stage_partners": _on(lambda w: w.partners),
    "stage_managers": _on(lambda w: w.managers),
    "investors_enriched": _on(lambda w: w.investors_enriched),
    "managers_enriched": _on(lambda w: w.managers_enriched),
    "investor_by_email": _on(lambda w: w.investor_by_email),
    "manager_by_email": _on(lambda w: w.manager_by_email),
    "identity_lookup": _on(lambda w: w.identities),
    "label_lookup": _on(lambda w: w.labels),
    "resolve_requesters": _on(lambda w: w.requesters),
    "attribution": _on(lambda w: w.resolved),
    "dim_partner": _on(lambda w: w.dim_partner),
    "dim_manager": _on(lambda w: w.dim_manager),
    "dim_entity": _on(lambda w: w.dim_entity),
    "dim_investor": _on(lambda w: w.dim_investor),
    "dim_close": _on(lambda w: w.dim_close),
    "ticket_fact": _on(lambda w: w.ticket_fact),
    "ticket_tags": _on(lambda w: w.ticket_tags),
    "investor_summary": _on(lambda w: w.investor_summary),
    "team_pressure_weekly": _on(lambda w: w.team_pressure_weekly),
    "partner_pressure_weekly": _on(lambda w: w.partner_pressure_weekly),
    "close_pressure_14": _on(lambda w: w.close_pressure),
    "close_pressure_21": _on(lambda w: w.close_pressure, window_days=21),
    "staffing_forecast": _on(lambda w: w.staffing_forecast),
    "load_estimate": _on(lambda w: w.load_estimate),
    "theme_summary": _on(lambda w: w.theme_summary),
    "attribution_health": _on(lambda w: w.attribution_health),
    "incremental_merge": _on(incremental_merge),
    "clustered_merge": _on(clustered_merge),
    "close_ticket_pairs": _on(near_pairs),
    "close_ticket_measures": _on(near_measures),
    "schema_sync": _on(schema_sync),
    "sketched_investors": _on(sketched_investors),
    "sketched_themes": _on(sketched_themes),
    "kept_team_weekly": _on(kept("mart_is_pressure_weekly")),
    "kept_partner_weekly": _on(kept("mart_partner_pressure_weekly")),
    "kept_themes": _on(kept("mart_theme_ticket_summary")),
    "kept_health": _on(kept("mart_attribution_health")),
    "released_tables": _on(released),
    "lenient_good": _on(lambda w: lenient_load(w).good),
    "lenient_quarantine": _on(lambda w: lenient_load(w).quarantine.drop("row_id")),
    "weekly_from_stream": weekly_from_stream,
    "tags_by_sql": _on(tags_by_sql),
    "check_unique": _on(lambda w: checks.unique(w.investors, "email")),
    "check_not_null": _on(lambda w: checks.not_null(w.dim_investor, "created_at")),
    "check_accepted": _on(
        lambda w: checks.accepted_values(w.entities, "entity_type", ["furniture", "household"])
    ),
    "check_orphans": _on(
        lambda w: checks.relationships(w.closes, "partner_id", w.partners, "partner_id")
    ),
    "check_key_overlap": _on(
        lambda w: checks.key_overlap(w.dim_investor, "email", w.dim_manager, "rm_email")
    ),
    "check_report": _on(lambda w: w.check()),
    "profile_tickets": _on(lambda w: profile(w.tickets, PROFILED)),
    "close_order_anomaly": _on(lambda w: close_order_anomalies(w.closes)),
    "build_synonyms": _on(synonyms),
    "aq_01": _on(lambda w: analyst.open_backlog(w.investor_summary)),
    "aq_02": _on(lambda w: analyst.slow_investors(w.investor_summary)),
    "aq_03": _on(lambda w: analyst.silent_investors(w.investor_summary)),
    "aq_04": _on(lambda w: analyst.theme_totals(w.theme_summary, since=date(1999, 1, 1))),
    "aq_05": _on(lambda w: analyst.theme_growth(w.theme_summary, w.settings)),
    "aq_06": _on(lambda w: analyst.forecast_ahead(w.staffing_forecast, w.settings)),
    "aq_07": _on(lambda w: analyst.expected_by_partner(w.staffing_forecast, w.settings)),
    "aq_08": _on(lambda w: analyst.recent_weeks(w.team_pressure_weekly, w.settings)),
    "aq_09": _on(lambda w: analyst.peak_weeks(w.team_pressure_weekly)),
    "aq_10": _on(lambda w: analyst.busiest_partners(w.partner_pressure_weekly, w.settings)),
    "aq_11": _on(lambda w: analyst.heaviest_closes(w.close_pressure)),
    "aq_12": _on(lambda w: analyst.latest_rates(w.attribution_health)),
    "aq_13": _on(lambda w: analyst.urgent_open_this_week(w.ticket_fact, w.settings)),
    "aq_14": _on(lambda w: analyst.partner_volume(w.ticket_fact, w.dim_partner, w.settings)),
    "event_hours": event_hours,
    "event_weekly": event_weekly,
}
