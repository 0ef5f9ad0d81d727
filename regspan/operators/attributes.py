"""Attributes of registrations.

Every `reg_*` operator returns `node_id` and one column, as a bag: a registration with two
funders has two rows, and repeated source rows stay repeated unless `distinct` is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.functions.columns import mined_key
from regspan.functions.joins import left_join_counted, left_join_many
from regspan.operators.samples import Sample, nodes, sample_filter
from regspan.schemas import (
    AFFILIATED,
    FUNDED,
    FUNDING_SCHEMA,
    GUID_OF_NODE,
    SUPPORTED_ATTRIBUTES,
    UNAFFILIATED,
    UNFUNDED,
    UNSPECIFIED,
)
from regspan.sources.dump import Dump


Join = Callable[[DataFrame, DataFrame, str], DataFrame]


def _bag(df: DataFrame, attribute: str, value: Column, distinct: bool) -> DataFrame:
    bag = df.select("node_id", value.alias(attribute))
    return bag.distinct() if distinct else bag


def funder_metadata(dump: Dump, cache_path: str | None = None) -> DataFrame:
    """One row per funder named in a metadata record.

    Text that is not JSON fails the query instead of losing funders. With `cache_path` the
    rows are stored there and read back.
    """
    funders = F.from_json("funding_info", FUNDING_SCHEMA, {"mode": "FAILFAST"})
    named = (
        dump["metadata_records"]
        .where(F.col("funding_info") != "[]")
        .select(F.col("guid_id").alias("record_id"), "resource_type_general", F.inline(funders))
        .select(
            "record_id",
            "resource_type_general",
            F.col("funder_name").alias("funder"),
            "funder_identifier",
        )
    )
    if cache_path is None:
        return named
    named.write.mode("overwrite").parquet(cache_path)
    return named.sparkSession.read.parquet(cache_path)


def _funders(dump: Dump, sample: Sample, join: Join = left_join_many) -> DataFrame:
    guids = dump["guids"].where(F.col("content_type_id") == GUID_OF_NODE).select(
        F.col("id").alias("record_id"), F.col("object_id").alias("node_id")
    )
    funders = funder_metadata(dump).select("record_id", "funder").join(guids, "record_id")
    registrations = nodes(dump, sample).select(F.col("id").alias("node_id"))
    return join(registrations, funders.select("node_id", "funder"), "node_id")


def _institutions(
    dump: Dump, sample: Sample, nodetype: str = "registration", join: Join = left_join_many
) -> DataFrame:
    institutions = dump["institutions"].select(
        F.col("id").alias("institution_id"), F.col("name").alias("institution")
    )
    # The bridge meets the dimension first, on its own side of the join with the nodes.
    affiliations = dump["affiliations"].select(
        F.col("abstractnode_id").alias("node_id"), "institution_id"
    ).join(institutions, "institution_id", "left")
    base = nodes(dump, sample, nodetype).select(F.col("id").alias("node_id"))
    return join(base, affiliations.select("node_id", "institution"), "node_id")


def _subjects(dump: Dump, sample: Sample, join: Join = left_join_many) -> DataFrame:
    subjects = dump["subjects"].select(
        F.col("id").alias("subject_id"), F.col("text").alias("subject"), "parent_id"
    )
    assigned = dump["node_subjects"].select(
        F.col("abstractnode_id").alias("node_id"), "subject_id"
    ).join(subjects, "subject_id", "left")
    registrations = nodes(dump, sample).select(F.col("id").alias("node_id"))
    return join(registrations, assigned.select("node_id", "subject", "parent_id"), "node_id")


def _funder() -> Column:
    return F.coalesce("funder", F.lit(UNFUNDED))


def _funded() -> Column:
    return F.when(F.col("funder").isNull(), UNFUNDED).otherwise(FUNDED)


def _institution() -> Column:
    return F.coalesce("institution", F.lit(UNAFFILIATED))


def _affiliated() -> Column:
    return F.when(F.col("institution").isNull(), UNAFFILIATED).otherwise(AFFILIATED)


def _subject() -> Column:
    return F.coalesce("subject", F.lit(UNSPECIFIED))


def reg_funder(dump: Dump, sample: Sample = None, distinct: bool = False) -> DataFrame:
    """Funder names."""
    return _bag(_funders(dump, sample), "funder", _funder(), distinct)


def reg_funded(dump: Dump, sample: Sample = None, distinct: bool = False) -> DataFrame:
    """Funded or not, once per funder."""
    return _bag(_funders(dump, sample), "funded", _funded(), distinct)


def reg_institution(
    dump: Dump, sample: Sample = None, nodetype: str = "registration", distinct: bool = False
) -> DataFrame:
    """Names of affiliated institutions."""
    return _bag(_institutions(dump, sample, nodetype), "institution", _institution(), distinct)


def reg_affiliated(
    dump: Dump, sample: Sample = None, nodetype: str = "registration", distinct: bool = False
) -> DataFrame:
    """Affiliated or not, once per affiliation."""
    return _bag(_institutions(dump, sample, nodetype), "affiliated", _affiliated(), distinct)


def reg_template(dump: Dump, sample: Sample = None, distinct: bool = False) -> DataFrame:
    """Name of the template whose id stands in the registration's metadata.

    Registrations without metadata are left out; an id without a template gives NULL.
    """
    templates = dump["templates"].select(
        F.col("_id").alias("template_id"), F.col("name").alias("template")
    )
    registrations = nodes(dump, sample).where(F.col("registered_meta").isNotNull()).select(
        F.col("id").alias("node_id"), mined_key("registered_meta").alias("template_id")
    )
    named = registrations.join(templates, "template_id", "left")
    return _bag(named, "template", F.col("template"), distinct)


def reg_provider(
    dump: Dump, sample: Sample = None, nodetype: str = "registration", distinct: bool = False
) -> DataFrame:
    """Name of the registry; NULL without one."""
    providers = dump["providers"].select(
        F.col("id").alias("provider_id"), F.col("name").alias("provider")
    )
    base = nodes(dump, sample, nodetype).select(F.col("id").alias("node_id"), "provider_id")
    named = base.join(providers, "provider_id", "left")
    return _bag(named, "provider", F.col("provider"), distinct)


def reg_subject(dump: Dump, sample: Sample = None, distinct: bool = False) -> DataFrame:
    """Subjects of any level."""
    return _bag(_subjects(dump, sample), "subject", _subject(), distinct)


def reg_subject_parent(dump: Dump, sample: Sample = None, distinct: bool = False) -> DataFrame:
    """Top-level subjects. Registrations with lower subjects only have no row."""
    top = _subjects(dump, sample).where(F.col("parent_id").isNull())
    return _bag(top, "subject_parent", _subject(), distinct)


def reg_creator(
    dump: Dump,
    sample: Sample = None,
    creator_sample: Sample = None,
    nodetype: str = "registration",
    creator_filter_mode: str = "left",
) -> DataFrame:
    """Creator of each node.

    The filter on users is a left join in "left" mode and does not change the result;
    "semi" keeps only nodes whose creator is in the sample.
    """
    if creator_filter_mode not in ("left", "semi"):
        raise ValueError("creator_filter_mode must be 'left' or 'semi'")
    base = nodes(dump, sample, nodetype).select(F.col("id").alias("node_id"), "creator_id")
    if creator_filter_mode == "left":
        # A left join to the primary key of the users adds no rows and no columns. The sample
        # is resolved all the same, so that a wrong column is an error in both modes.
        sample_filter(dump["users"], creator_sample)
        return base
    users = sample_filter(dump["users"], creator_sample).select(F.col("id").alias("creator_id"))
    return base.join(users, "creator_id", "left_semi").select("node_id", "creator_id")


def funded_only(funded: DataFrame) -> DataFrame:
    """Rows of the `funded` attribute that say so."""
    return funded.where(F.col("funded") == FUNDED)


ATTRIBUTE_OPERATORS = {
    "institution": reg_institution,
    "funder": reg_funder,
    "funded": reg_funded,
    "template": reg_template,
    "provider": reg_provider,
    "subject": reg_subject,
    "subject_parent": reg_subject_parent,
    "affiliated": reg_affiliated,
}

# Attributes read off the same joined rows: source columns, and per attribute its value and
# the rows it has.
_SHARED_JOINS = {
    ("institution", "affiliated"): _institutions,
    ("funder", "funded"): _funders,
    ("subject", "subject_parent"): _subjects,
}


def _tagged(attribute: str, value: Column) -> Column:
    return F.struct(F.lit(attribute).alias("attribute"), value.alias("subgroup"))


def _entries(wanted: Sequence[str]) -> Column:
    """Array of (attribute, subgroup) a joined row contributes."""
    values = {
        "institution": _institution,
        "affiliated": _affiliated,
        "funder": _funder,
        "funded": _funded,
        "subject": _subject,
        "subject_parent": _subject,
    }
    always = [_tagged(a, values[a]()) for a in wanted if a != "subject_parent"]
    if "subject_parent" not in wanted:
        return F.array(*always)
    with_parent = F.array(*always, _tagged("subject_parent", _subject()))
    # Lower-level subjects contribute to "subject" only.
    lower = F.array(*always) if always else None
    return F.when(F.col("parent_id").isNull(), with_parent).otherwise(lower)


def weighted_attribute(dump: Dump, attribute: str, sample: Sample = None) -> DataFrame:
    """One attribute as (node_id, <attribute>, weight): the bag with repeated rows counted.

    What summaries need: source rows are counted before they meet the registrations.
    """
    tall = assign_attributes(dump, sample, [attribute], weights=True)
    return tall.select("node_id", F.col("subgroup").alias(attribute), "weight")


def assign_attributes(
    dump: Dump,
    sample: Sample = None,
    attributes: Sequence[str] = SUPPORTED_ATTRIBUTES,
    weights: bool = False,
) -> DataFrame:
    """All attributes as one tall bag (node_id, attribute, subgroup).

    Attributes that come from the same joins share them. With `weights` repeated rows are
    counted in a further column `weight`, which summaries take as well.
    """
    join, weight = (left_join_counted, ["weight"]) if weights else (left_join_many, [])
    unknown = set(attributes) - set(SUPPORTED_ATTRIBUTES)
    if unknown or not attributes:
        raise ValueError(f"unknown attributes: {sorted(unknown)}" if unknown else "no attributes")
    parts = []
    for pair, source in _SHARED_JOINS.items():
        wanted = [a for a in pair if a in attributes]
        if wanted:
            rows = source(dump, sample, join=join)
            parts.append(rows.select("node_id", F.inline(_entries(wanted)), *weight))
    for attribute in ("template", "provider"):
        if attribute in attributes:
            bag = ATTRIBUTE_OPERATORS[attribute](dump, sample)
            parts.append(
                bag.select(
                    "node_id",
                    F.lit(attribute).alias("attribute"),
                    F.col(attribute).alias("subgroup"),
                    *(F.lit(1).cast("long").alias(w) for w in weight),
                )
            )
    tall = parts[0]
    for part in parts[1:]:
        tall = tall.unionByName(part)
    return tall
