"""Plain SQL for every query, by definition rather than by the way Spark computes it.

The panel is the snapshot at each cutoff, one after the other; summaries are one left join
and one aggregate per attribute.
"""

from __future__ import annotations

from checks.fixtures import VIEWS

CUTOFF = "2001-12-01"
FIRST_CUTOFF = "1999-01-01"
# Inside the data, so that much of it is cut off; log rows there have times of day.
MID_CUTOFF = "2000-06-15"
FIRST_MID_CUTOFF = "1999-03-15"

_VALID = """is_public AND deleted IS NULL AND registered_date IS NOT NULL
 AND moderation_state = 'accepted' AND (spam_status <> 2 OR spam_status IS NULL)"""

_OUT = "artifact_type IN (1, 11, 21, 41)"
_OC = "artifact_type = 31"
_KEPT = "artifact_deleted IS NULL"


def _sum_if(condition: str, name: str) -> str:
    return f"CAST(sum(CAST({condition} AS INT)) AS BIGINT) AS {name}"


def _counts(history: str, keys: str) -> str:
    return f"""
SELECT *, CASE WHEN net_outputs > 0 AND net_outcomes > 0 THEN 1
               WHEN NOT (net_outputs > 0 AND net_outcomes > 0) THEN 0 END AS is_los
FROM (SELECT *, linked_outputs + linked_outcomes AS total_resources,
        linked_outputs + linked_outcomes - (removed_outputs + removed_outcomes) AS net_resources,
        linked_outputs - removed_outputs AS net_outputs,
        linked_outcomes - removed_outcomes AS net_outcomes
      FROM (SELECT {keys},
              {_sum_if(f'({_OUT}) AND {_KEPT}', 'linked_outputs')},
              {_sum_if(f'({_OC}) AND {_KEPT}', 'linked_outcomes')},
              {_sum_if(f'({_OUT}) AND NOT ({_KEPT})', 'removed_outputs')},
              {_sum_if(f'({_OC}) AND NOT ({_KEPT})', 'removed_outcomes')},
              min(artifact_created) FILTER (({_OUT}) AND {_KEPT}) AS first_linked_output,
              min(artifact_created) FILTER (({_OC}) AND {_KEPT}) AS first_linked_outcome
            FROM {history} GROUP BY {keys}))"""


_MEASURES = """CAST(count(*) AS BIGINT) AS n_osr,
  CAST(coalesce(sum(CAST(net_resources > 0 AS INT)), 0) AS BIGINT) AS have_resources,
  CAST(coalesce(sum(CAST(net_outputs > 0 AS INT)), 0) AS BIGINT) AS have_outputs,
  CAST(coalesce(sum(CAST(net_outcomes > 0 AS INT)), 0) AS BIGINT) AS have_outcomes,
  CAST(coalesce(sum(is_los), 0) AS BIGINT) AS are_los"""

_SHARES = """n_osr / (sum(n_osr) OVER ())::DOUBLE AS prop_osr,
  have_resources / n_osr AS prop_resources, have_outputs / n_osr AS prop_outputs,
  have_outcomes / n_osr AS prop_outcomes, are_los / n_osr AS prop_los"""


def _summary(source: str, keys: str) -> str:
    return f"""SELECT *, {_SHARES} FROM (
 SELECT {keys}, {_MEASURES} FROM {source} GROUP BY {keys})"""


_ATTRIBUTES = (
    "institution", "funder", "funded", "template", "provider", "subject", "subject_parent",
    "affiliated",
)


def _by_attribute(attribute: str) -> str:
    joined = f"panel LEFT JOIN attr_{attribute} USING (node_id)"
    return f"""SELECT '{attribute}' AS attribute, {attribute} AS subgroup, * EXCLUDE ({attribute})
 FROM ({_summary(joined, f'{attribute}, date')})"""


_MEASURE_NAMES = (
    "n_osr", "have_resources", "have_outputs", "have_outcomes", "are_los", "prop_osr",
    "prop_resources", "prop_outputs", "prop_outcomes", "prop_los",
)


def _longform(source: str, groups: str, measures: tuple[str, ...] = _MEASURE_NAMES) -> str:
    ids = f"{groups}, " if groups else ""
    long = " UNION ALL ".join(
        f"SELECT {ids}date, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}"
        for m in measures
    )
    moments = f"""SELECT *, value - lag AS delta,
      CASE WHEN lag = 0 THEN NULL ELSE (value - lag) / lag END AS growth
    FROM (SELECT *, lag(value) OVER (PARTITION BY {ids}metric ORDER BY date) AS lag
          FROM ({long}))"""
    return " UNION ALL ".join(
        f"SELECT {ids}date, metric, '{m}' AS moment, {m} AS value FROM ({moments})"
        for m in ("value", "lag", "delta", "growth")
    )


def _typed(source: str) -> str:
    return f"""SELECT * REPLACE (regexp_replace(metric, '^(n_|are_|have_)', '') AS metric),
 'count' AS value_type FROM {source} WHERE regexp_matches(metric, '^(n_|are_|have_)')
UNION ALL SELECT * REPLACE (regexp_replace(metric, '^prop_', '') AS metric),
 'proportion' AS value_type FROM {source} WHERE regexp_matches(metric, '^prop_')"""


_LINES = """(VALUES (1, 'osr', 'count', 'Open Registrations'),
 (2, 'outputs', 'count', 'Open Registrations with Linked Outputs'),
 (3, 'outcomes', 'count', 'Open Registrations with Linked Outcomes'),
 (4, 'los', 'count', 'Lifecycle Open Science (LOS) Registrations'),
 (5, 'los', 'proportion', 'Share of Open Registrations that are LOS'))
 lines(line, metric, value_type, indicator)"""
_SECTIONS = """(VALUES ('TOTALS', 'value'), ('NET CHANGE', 'delta'), ('% GROWTH', 'growth'))
 sections(section, moment)"""


def _annual(keys: str, source: str) -> str:
    month_of = ", ".join(
        f"max(value) FILTER (month(date) = {m}) AS \"{m}\"" for m in range(1, 13)
    )
    same = " AND ".join(f"t.{k.strip()} IS NOT DISTINCT FROM r.{k.strip()}" for k in keys.split(","))
    tables = ", ".join(f"t.{k.strip()}" for k in keys.split(","))
    return f"""SELECT {tables}, section, line, indicator, {month_of}
FROM (SELECT DISTINCT {keys} FROM {source}) t, {_LINES}, {_SECTIONS}
LEFT JOIN {source} r ON {same} AND r.metric = lines.metric
  AND r.value_type = lines.value_type AND r.moment = sections.moment
GROUP BY {tables}, section, line, indicator"""


def _formatted(legacy: bool) -> str:
    share = "line = 5" if legacy else "line = 5 OR section = '% GROWTH'"

    def month(m: int) -> str:
        v = f'"{m}"'
        quirk = f"WHEN {v} < 13 AND {v} = {m} THEN '{m}' " if legacy else ""
        return f"""CASE {quirk}WHEN {v} IS NULL THEN NULL
 WHEN {share} THEN printf('%.2f', {v} * 100)
 ELSE format('{{:,}}', CAST(round_even({v}, 0) AS BIGINT)) END AS {v}"""

    months = ", ".join(month(m) for m in range(1, 13))
    return f"SELECT year, section, line, indicator, {months} FROM annual"


# Intermediate tables, each in terms of earlier ones.
_STEPS = {
    **VIEWS,
    "valid": f"SELECT * FROM nodes WHERE type = 'osf.registration' AND {_VALID}",
    "metadata": """
SELECT guid_id AS record_id, resource_type_general,
  json_extract_string(j, '$.funder_name') AS funder,
  json_extract_string(j, '$.funder_identifier') AS funder_identifier
FROM (SELECT *, unnest(CAST(funding_info AS JSON[])) AS j FROM metadata_records
      WHERE funding_info <> '[]')""",
    "node_funders": """
SELECT object_id AS node_id, funder FROM metadata JOIN guids ON guids.id = record_id
WHERE content_type_id = 30""",
    "attr_funder": """SELECT valid.id AS node_id, coalesce(funder, 'Unfunded') AS funder
FROM valid LEFT JOIN node_funders ON node_funders.node_id = valid.id""",
    "attr_funded": """SELECT valid.id AS node_id,
  CASE WHEN funder IS NULL THEN 'Unfunded' ELSE 'Funded' END AS funded
FROM valid LEFT JOIN node_funders ON node_funders.node_id = valid.id""",
    "attr_institution": """SELECT valid.id AS node_id, coalesce(name, 'Unaffiliated') AS institution
FROM valid LEFT JOIN affiliations ON abstractnode_id = valid.id
LEFT JOIN institutions ON institutions.id = institution_id""",
    "attr_affiliated": """SELECT valid.id AS node_id,
  CASE WHEN name IS NULL THEN 'Unaffiliated' ELSE 'OSFI-Affiliate' END AS affiliated
FROM valid LEFT JOIN affiliations ON abstractnode_id = valid.id
LEFT JOIN institutions ON institutions.id = institution_id""",
    "attr_template": """SELECT valid.id AS node_id, templates.name AS template
FROM valid LEFT JOIN templates
  ON _id = regexp_extract(registered_meta, '[[:digit:]][[:alnum:]]{5,}')
WHERE registered_meta IS NOT NULL""",
    "attr_provider": """SELECT valid.id AS node_id, providers.name AS provider
FROM valid LEFT JOIN providers ON providers.id = provider_id""",
    "attr_subject": """SELECT valid.id AS node_id, coalesce(text, 'Unspecified') AS subject
FROM valid LEFT JOIN node_subjects ON abstractnode_id = valid.id
LEFT JOIN subjects ON subjects.id = subject_id""",
    "attr_subject_parent": """
SELECT valid.id AS node_id, coalesce(text, 'Unspecified') AS subject_parent
FROM valid LEFT JOIN node_subjects ON abstractnode_id = valid.id
LEFT JOIN subjects ON subjects.id = subject_id
WHERE parent_id IS NULL""",
    "added": """SELECT node_id, created,
  regexp_extract(params, '[[:digit:]][[:alnum:]]{5,}') AS artifact_id
FROM logs WHERE action = 'resource_identifier_added'""",
    "final": "SELECT * FROM artifacts WHERE finalized",
    "history": f"""
SELECT valid.id AS node_id, artifact_id, artifact_type, artifact_created, artifact_deleted
FROM valid
LEFT JOIN (SELECT * FROM added WHERE created <= DATE '{CUTOFF}') a ON a.node_id = valid.id
LEFT JOIN (SELECT _id AS artifact_id, artifact_type, created AS artifact_created,
             deleted AS artifact_deleted
           FROM final WHERE created <= DATE '{CUTOFF}'
             AND (deleted IS NULL OR deleted > DATE '{CUTOFF}')) f USING (artifact_id)
WHERE valid.created <= DATE '{CUTOFF}'""",
    "counts": _counts("history", "node_id"),
    "cutoffs": f"""SELECT CAST(d AS DATE) AS date FROM generate_series(
  TIMESTAMP '{FIRST_CUTOFF}', TIMESTAMP '{CUTOFF}', INTERVAL 1 MONTH) t(d)""",
    "all_history": """
SELECT c.date, v.id AS node_id, f.artifact_type, f.created AS artifact_created,
  f.deleted AS artifact_deleted
FROM cutoffs c JOIN valid v ON v.created <= c.date
LEFT JOIN added a ON a.node_id = v.id AND a.created <= c.date
LEFT JOIN final f ON f._id = a.artifact_id AND f.created <= c.date
  AND (f.deleted IS NULL OR f.deleted > c.date)""",
    "all_counts": _counts("all_history", "date, node_id"),
    "panel": """
SELECT *, CASE WHEN is_los = 1 AND (los_lag IS NULL OR los_lag = 0) THEN 1
               WHEN is_los = 0 AND los_lag = 1 THEN -1 ELSE 0 END AS los_change
FROM (SELECT *, lag(is_los) OVER (PARTITION BY node_id ORDER BY date) AS los_lag
      FROM all_counts)""",
    "summary_overall": _summary("panel", "date"),
    "summary_institution": _summary(
        "panel LEFT JOIN attr_institution USING (node_id)", "institution, date"
    ),
    "summary_funded": _summary("panel LEFT JOIN attr_funded USING (node_id)", "funded, date"),
    "summary_all": " UNION ALL ".join(_by_attribute(a) for a in _ATTRIBUTES)
    + """ UNION ALL SELECT 'overall' AS attribute, CAST(NULL AS VARCHAR) AS subgroup, *
 FROM summary_overall""",
    "long_all": _longform("summary_all", "attribute, subgroup"),
    "report": _typed("long_all"),
    "overall_years": """SELECT *, CAST(year(date) AS INT) AS year FROM report
WHERE attribute = 'overall'""",
    "all_years": "SELECT *, CAST(year(date) AS INT) AS year FROM report",
    "annual": _annual("year", "overall_years"),
}


def _uses(sql: str) -> list[str]:
    """Steps a statement needs, in order."""
    import re

    needed: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & _STEPS.keys() - needed:
            needed.add(name)
            pending.append(_STEPS[name])
    return [name for name in _STEPS if name in needed]


def _query(sql: str) -> str:
    steps = ",\n".join(f"{name} AS ({_STEPS[name].strip()})" for name in _uses(sql))
    return f"WITH {steps}\n{sql}" if steps else sql


_FINAL = {
    "scan_table": "SELECT * FROM orders",
    "valid_registrations": "SELECT * FROM valid",
    "sample_filter": f"""SELECT * FROM nodes WHERE type = 'osf.registration'
AND created >= DATE '2000-01-01' AND provider_id = 2 AND {_VALID}""",
    "cutoff_spine": """SELECT CAST(d AS DATE) AS date FROM (
  SELECT unnest(generate_series(date_trunc('month', min(created))::TIMESTAMP,
    max(created)::DATE::TIMESTAMP, INTERVAL 1 MONTH)) AS d
  FROM nodes WHERE type = 'osf.registration')""",
    "funder_metadata": "SELECT * FROM metadata",
    **{f"reg_{a}": f"SELECT * FROM attr_{a}" for a in _ATTRIBUTES},
    "reg_creator": f"""SELECT n.id AS node_id, n.creator_id FROM nodes n
LEFT JOIN (SELECT id AS creator_id FROM users WHERE id > 100) u USING (creator_id)
WHERE type = 'osf.registration' AND {_VALID}""",
    "reg_creator_semi": f"""SELECT id AS node_id, creator_id FROM nodes
WHERE type = 'osf.registration' AND {_VALID}
AND creator_id IN (SELECT id FROM users WHERE id > 100)""",
    "funded_only": "SELECT * FROM attr_funded WHERE funded = 'Funded'",
    "assign_attributes": " UNION ALL ".join(
        f"SELECT node_id, '{a}' AS attribute, {a} AS subgroup FROM attr_{a}" for a in _ATTRIBUTES
    ),
    "resource_history": "SELECT * FROM history",
    "resource_counts_at_date": "SELECT * FROM counts",
    "event_history_panel": "SELECT * FROM panel",
    "los_summarizer": f"""SELECT * FROM (
 {_summary('panel LEFT JOIN attr_provider USING (node_id)', 'provider, date')})
WHERE prop_osr >= 0.005""",
    "los_summary_by_attribute_overall": "SELECT * FROM summary_overall",
    "los_summary_by_attribute_institution": "SELECT * FROM summary_institution",
    "los_summary_all": "SELECT * FROM summary_all",
    "los_summary_all_from_panel": "SELECT * FROM summary_all",
    "los_leaderboard": """
SELECT institution, n_regs, n_los, n_los / n_regs AS prop_los FROM (
  SELECT institution, CAST(count(*) AS BIGINT) AS n_regs,
    CAST(coalesce(sum(is_los), 0) AS BIGINT) AS n_los
  FROM (SELECT n.id AS node_id, coalesce(name, 'Unaffiliated') AS institution
        FROM (SELECT id FROM nodes WHERE type = 'osf.registration') n
        LEFT JOIN affiliations ON abstractnode_id = n.id
        LEFT JOIN institutions ON institutions.id = institution_id) i
  LEFT JOIN counts USING (node_id) GROUP BY institution)""",
    "latest_snapshot": """SELECT n_osr, are_los, prop_los, have_outputs, prop_outputs,
  have_outcomes, prop_outcomes
FROM summary_overall WHERE date = (SELECT max(date) FROM summary_overall)""",
    "latest_snapshot_institution": """SELECT institution, n_osr, are_los, prop_los, have_outputs,
  prop_outputs, have_outcomes, prop_outcomes
FROM summary_institution WHERE date = (SELECT max(date) FROM summary_institution)""",
    "summary_longform": _longform("summary_overall", ""),
    "summary_longform_institution": _longform("summary_institution", "institution"),
    "value_types": _typed(
        "(" + _longform("summary_funded", "funded", ("date_rank", *_MEASURE_NAMES)).replace(
            "CAST(date_rank AS DOUBLE)", "CAST(month(date) AS DOUBLE)"
        ) + ")"
    ),
    "reporting_dataset": "SELECT * FROM report",
    "report_los_today": """SELECT * FROM report
WHERE attribute = 'overall' AND date = (SELECT max(date) FROM report) AND metric = 'los'""",
    "report_los_share_by_institution": """SELECT * FROM report
WHERE attribute = 'institution' AND metric = 'los' AND value_type = 'proportion'
  AND moment = 'value' AND date = (SELECT max(date) FROM report)""",
    "report_growth_series": """SELECT * FROM report
WHERE attribute = 'overall' AND metric = 'los' AND value_type = 'count' AND moment = 'growth'""",
    "annual_indicator_pivot": "SELECT * FROM annual",
    "annual_indicator_pivot_by_subgroup": _annual("attribute, subgroup, year", "all_years"),
    "annual_number_format": _formatted(legacy=False),
    "annual_number_format_legacy": _formatted(legacy=True),
}


_ZEROS = ("linked_outputs", "linked_outcomes", "total_resources", "net_resources",
  "net_outputs", "net_outcomes", "is_los", "removed_outputs", "removed_outcomes")

_OPTIONS = {
    "resource_counts_at_date_null_as_zero": "SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _ZEROS)
    + ") FROM counts",
    "los_summary_share_within_date": """SELECT * REPLACE (
  n_osr / (sum(n_osr) OVER (PARTITION BY date))::DOUBLE AS prop_osr) FROM summary_institution""",
    "reg_subject_distinct": "SELECT DISTINCT * FROM attr_subject",
    "reg_provider_of_nodes": """SELECT n.id AS node_id, providers.name AS provider
FROM nodes n LEFT JOIN providers ON providers.id = provider_id WHERE type = 'osf.node'""",
    "annual_report_sink": "SELECT * FROM annual",
}

# The same by definition, at cutoffs inside the data.
_MID = {
    "resource_history_mid": "SELECT * FROM history",
    "resource_counts_at_date_mid": "SELECT * FROM counts",
    "los_leaderboard_mid": _FINAL["los_leaderboard"],
    "event_history_panel_mid": "SELECT * FROM panel",
    "event_history_measures_mid": f"""
SELECT *, CASE WHEN is_los = 1 AND (los_lag IS NULL OR los_lag = 0) THEN 1
               WHEN is_los = 0 AND los_lag = 1 THEN -1 ELSE 0 END AS los_change
FROM (SELECT *, lag(is_los) OVER (PARTITION BY node_id ORDER BY date) AS los_lag
      FROM (SELECT *, CAST(live_outputs > 0 AND types > 1 AS INTEGER) AS is_los
            FROM (SELECT date, node_id,
                    CAST(sum(CASE WHEN {_OUT} AND {_KEPT} THEN 1 ELSE 0 END) AS BIGINT) AS live_outputs,
                    count(DISTINCT artifact_type) AS types,
                    min(artifact_created) AS first_visible, max(artifact_created) AS latest_visible
                  FROM all_history GROUP BY date, node_id)))""",
    "history_of_few_registrations": """SELECT * FROM panel
WHERE node_id IN (SELECT id FROM nodes WHERE provider_id = 2)""",
}


def _at_mid(sql: str) -> str:
    return sql.replace(CUTOFF, MID_CUTOFF).replace(FIRST_CUTOFF, FIRST_MID_CUTOFF)


# Cutoffs every few hours over days inside the data, where log rows have times of day.
FIRST_HOUR, LAST_HOUR, HOURS = "2000-06-10 00:00:00", "2000-06-15 00:00:00", 3


def _hourly(sql: str) -> str:
    """The same by definition at instants: only the series of cutoffs differs."""
    hours = f"""SELECT d AS date FROM generate_series(
  TIMESTAMP '{FIRST_HOUR}', TIMESTAMP '{LAST_HOUR}', INTERVAL {HOURS} HOUR) t(d)"""
    return _query(sql).replace(_STEPS["cutoffs"].strip(), hours)


def oracle_sql() -> dict[str, str]:
    plain = {name: _query(sql) for name, sql in {**_FINAL, **_OPTIONS}.items()}
    hourly = {"event_history_panel_hourly": _hourly("SELECT * FROM panel")}
    return plain | {name: _at_mid(_query(sql)) for name, sql in _MID.items()} | hourly
