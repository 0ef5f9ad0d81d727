"""Every query by name, over the given tables of one scale."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import fixture_dump
from checks.oracles import (
    CUTOFF, FIRST_CUTOFF, FIRST_HOUR, FIRST_MID_CUTOFF, HOURS, LAST_HOUR, MID_CUTOFF,
)
from regspan.functions.cutoffs import cutoff_dates
from regspan.operators import annual, attributes, history, reporting, samples, summary
from regspan.schemas import OVERALL, SUPPORTED_ATTRIBUTES, VALID_REGISTRATION
from regspan.sources.dump import Dump, scan_table

CUTOFFS = cutoff_dates(FIRST_CUTOFF, CUTOFF)
MID_CUTOFFS = cutoff_dates(FIRST_MID_CUTOFF, MID_CUTOFF)
HOURLY_CUTOFFS = cutoff_dates(FIRST_HOUR, LAST_HOUR, f"{HOURS} hours")


def _panel(dump: Dump) -> DataFrame:
    return history.event_history_panel(dump, CUTOFFS)


def _bag(dump: Dump, attribute: str) -> DataFrame | None:
    if attribute == OVERALL:
        return None
    return attributes.weighted_attribute(dump, attribute, VALID_REGISTRATION)


def _summary_of(dump: Dump, attribute: str = OVERALL) -> DataFrame:
    return summary.los_summary_by_attribute(_panel(dump), attribute, _bag(dump, attribute))


def _lines_of(dump: Dump, attribute: str = OVERALL) -> DataFrame:
    """The same in no order, for what is built on it."""
    return summary.summary_lines(_panel(dump), attribute, _bag(dump, attribute))


def _summary_all(dump: Dump, names: Sequence[str] = SUPPORTED_ATTRIBUTES) -> DataFrame:
    """Summaries of the overall line and of the named attributes."""
    runs = history.status_runs(dump, CUTOFFS)
    bag = attributes.assign_attributes(dump, VALID_REGISTRATION, names, weights=True)
    return summary.los_summary_of_runs(runs, bag, CUTOFFS, [*names, OVERALL])


def _report(dump: Dump, names: Sequence[str] = SUPPORTED_ATTRIBUTES) -> DataFrame:
    return reporting.reporting_dataset(_summary_all(dump, names))


def _overall_report(dump: Dump) -> DataFrame:
    return reporting.reporting_dataset(
        _lines_of(dump).select(
            F.lit(OVERALL).alias("attribute"), F.lit(None).cast("string").alias("subgroup"), "*"
        )
    )


def _spine(dump: Dump) -> DataFrame:
    return samples.cutoff_spine(samples.activity_span(dump), F.col("start"), F.col("end"))


def _sample(dump: Dump) -> DataFrame:
    return samples.nodes(
        dump, [*VALID_REGISTRATION, "created >= DATE '2000-01-01'", F.col("provider_id") == 2]
    )


def _summarizer(dump: Dump) -> DataFrame:
    # One provider per registration: this join cannot multiply rows.
    bag = attributes.reg_provider(dump, VALID_REGISTRATION)
    joined = _panel(dump).join(bag, "node_id", "left")
    return summary.los_summarizer(joined, "provider", "date", threshold=0.005)


def leaderboard(dump: Dump, cutoff: str = CUTOFF) -> DataFrame:
    return summary.los_leaderboard(
        attributes.weighted_attribute(dump, "institution"),
        history.resource_counts_at_date(dump, cutoff),
        "institution",
    )


def _creators(dump: Dump, mode: str) -> DataFrame:
    return attributes.reg_creator(
        dump, VALID_REGISTRATION, [F.col("id") > 100], creator_filter_mode=mode
    )


def _value_types(dump: Dump) -> DataFrame:
    with_other = _lines_of(dump, "funded").withColumn("date_rank", F.month("date"))
    return reporting.value_types(reporting.summary_longform(with_other, "funded"))


def _share_within_date(dump: Dump) -> DataFrame:
    return summary.summary_lines(
        _panel(dump), "institution", _bag(dump, "institution"), share_within=["date"]
    )


def _written_and_read(dump: Dump) -> DataFrame:
    """All years written, one of them again, and what is then there."""
    table = annual.annual_indicator_pivot(_overall_report(dump))
    spark = table.sparkSession
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/annual-{uuid.uuid4().hex}"
    annual.annual_report_sink(table, path)
    annual.annual_report_sink(table.where(F.col("year") == CUTOFFS[-1].year), path)
    return spark.read.parquet(path).select(table.columns)


def _attribute_query(name: str) -> Callable[[Dump], DataFrame]:
    return lambda dump: attributes.ATTRIBUTE_OPERATORS[name](dump, VALID_REGISTRATION)


ON_DUMP: dict[str, Callable[[Dump], DataFrame]] = {
    "valid_registrations": samples.valid_registrations,
    "sample_filter": _sample,
    "cutoff_spine": _spine,
    "funder_metadata": attributes.funder_metadata,
    **{f"reg_{name}": _attribute_query(name) for name in attributes.ATTRIBUTE_OPERATORS},
    "reg_creator": lambda dump: _creators(dump, "left"),
    "reg_creator_semi": lambda dump: _creators(dump, "semi"),
    "funded_only": lambda dump: attributes.funded_only(
        attributes.reg_funded(dump, VALID_REGISTRATION)
    ),
    "assign_attributes": lambda dump: attributes.assign_attributes(dump, VALID_REGISTRATION),
    "resource_history": lambda dump: history.resource_history(dump, CUTOFF),
    "resource_counts_at_date": lambda dump: history.resource_counts_at_date(dump, CUTOFF),
    "event_history_panel": _panel,
    "los_summarizer": _summarizer,
    "los_summary_by_attribute_overall": _summary_of,
    "los_summary_by_attribute_institution": lambda dump: _summary_of(dump, "institution"),
    "los_summary_all": _summary_all,
    "los_summary_all_from_panel": lambda dump: summary.los_summary_all(
        _panel(dump), attributes.assign_attributes(dump, VALID_REGISTRATION)
    ),
    "los_leaderboard": leaderboard,
    "latest_snapshot": lambda dump: summary.latest_snapshot(_lines_of(dump), latest=CUTOFFS[-1]),
    "latest_snapshot_institution": lambda dump: summary.latest_snapshot(
        _lines_of(dump, "institution"), "institution"
    ),
    "summary_longform": lambda dump: reporting.summary_longform(_lines_of(dump)),
    "summary_longform_institution": lambda dump: reporting.summary_longform(
        _lines_of(dump, "institution"), "institution"
    ),
    "value_types": _value_types,
    "reporting_dataset": _report,
    "report_los_today": lambda dump: reporting.report_los_today(
        _overall_report(dump), CUTOFFS[-1]
    ),
    "report_los_share_by_institution": lambda dump: reporting.report_los_share_by_institution(
        _report(dump, ["institution"]), CUTOFFS[-1]
    ),
    "report_growth_series": lambda dump: reporting.report_growth_series(_overall_report(dump)),
    "annual_indicator_pivot": lambda dump: annual.annual_indicator_pivot(_overall_report(dump)),
    "annual_indicator_pivot_by_subgroup": lambda dump: annual.annual_indicator_pivot(
        _report(dump), by_subgroup=True
    ),
    "annual_number_format": lambda dump: annual.annual_number_format(
        annual.annual_indicator_pivot(_overall_report(dump))
    ),
    "annual_number_format_legacy": lambda dump: annual.annual_number_format(
        annual.annual_indicator_pivot(_overall_report(dump)), legacy_format=True
    ),
}


ON_DUMP |= {
    "resource_history_mid": lambda dump: history.resource_history(dump, MID_CUTOFF),
    "resource_counts_at_date_mid": lambda dump: history.resource_counts_at_date(dump, MID_CUTOFF),
    "los_leaderboard_mid": lambda dump: leaderboard(dump, MID_CUTOFF),
    "event_history_panel_mid": lambda dump: history.event_history_panel(dump, MID_CUTOFFS),
    "event_history_panel_hourly": lambda dump: history.event_history_panel(dump, HOURLY_CUTOFFS),
    "event_history_measures_mid": lambda dump: history.event_history_panel(
        dump, MID_CUTOFFS, measures=_measures(), status=_two_kinds_and_a_live_output
    ),
    "history_of_few_registrations": lambda dump: history.event_history_panel(
        dump, MID_CUTOFFS, [*VALID_REGISTRATION, F.col("provider_id") == 2], small_sample=True
    ),
    "resource_counts_at_date_null_as_zero": lambda dump: history.resource_counts_at_date(
        dump, CUTOFF, null_as_zero=True
    ),
    "los_summary_share_within_date": _share_within_date,
    "reg_subject_distinct": lambda dump: attributes.reg_subject(
        dump, VALID_REGISTRATION, distinct=True
    ),
    "reg_provider_of_nodes": lambda dump: attributes.reg_provider(dump, nodetype="node"),
    "annual_report_sink": _written_and_read,
}


def _measures() -> list:
    """Measures of links that may end: live outputs, kinds, first and latest visible."""
    from regspan.operators.measures import Measure
    from regspan.schemas import OUTPUT_TYPES

    live_output = F.col("artifact_type").isin(*OUTPUT_TYPES) & F.col("artifact_deleted").isNull()
    return [
        Measure("live_outputs", "count", where=live_output),
        Measure("types", "distinct", "artifact_type"),
        Measure("first_visible", "min", "artifact_created"),
        Measure("latest_visible", "max", "artifact_created"),
    ]


def _two_kinds_and_a_live_output(m: dict) -> F.Column:
    return (m["live_outputs"] > 0) & (m["types"] > 1)


def _on_tables(query: Callable[[Dump], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(fixture_dump(spark, sf_dir))


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, "orders", sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"scan_table": _scan, **{name: _on_tables(query) for name, query in ON_DUMP.items()}}
