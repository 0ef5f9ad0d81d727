from collections import Counter

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from regspan.operators import attributes as A
from regspan.schemas import SUPPORTED_ATTRIBUTES
from tests.handmade import make_dump, node


@pytest.fixture
def small(spark):
    return make_dump(
        spark,
        nodes=[
            node(1, registered_meta='{"id": "564d31db8c5e4a7c9694b2be"}', provider_id=1),
            node(2, registered_meta='{"id": "abc4d31db"}', provider_id=9),
            node(3, registered_meta="nothing here"),
            node(4),
            node(9, type="osf.node"),
        ],
        templates=[("564d31db8c5e4a7c9694b2be", "Open-Ended"), ("4d31db", "Cut"), ("", "Empty")],
        providers=[(1, "Main")],
        institutions=[(1, "North"), (2, "South")],
        affiliations=[(1, 1), (1, 2), (1, 2), (2, 7), (9, 1)],
        subjects=[(1, "Biology", None), (2, "Botany", 1)],
        node_subjects=[(1, 1), (1, 2), (2, 2), (2, 2), (3, 99)],
        guids=[(101, 30, 1), (102, 30, 2), (103, 31, 3)],
        metadata_records=[
            (101, "Text", '[{"funder_name": "A", "funder_identifier": "a"}, {"funder_name": "B"}]'),
            (101, "Text", '[{"funder_name": "A"}]'),
            (102, "Text", '[{"funder_name": null, "funder_identifier": "x"}]'),
            (103, "Text", '[{"funder_name": "C"}]'),
            (102, "Text", "[]"),
            (102, "Text", None),
        ],
        users=[(1,)],
    )


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def test_funders_are_a_bag(small):
    assert bag(A.reg_funder(small)) == Counter(
        {(1, "A"): 2, (1, "B"): 1, (2, "Unfunded"): 1, (3, "Unfunded"): 1, (4, "Unfunded"): 1}
    )
    assert bag(A.reg_funded(small)) == Counter(
        {(1, "Funded"): 3, (2, "Unfunded"): 1, (3, "Unfunded"): 1, (4, "Unfunded"): 1}
    )
    assert A.reg_funder(small, distinct=True).count() == 5
    assert A.funded_only(A.reg_funded(small)).count() == 3


def test_malformed_funding_fails(spark, small):
    broken = make_dump(spark, metadata_records=[(1, "Text", '[{"funder_name": "A"')])
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        A.funder_metadata(broken).collect()


def test_funder_metadata_cache(small, tmp_path):
    path = str(tmp_path / "funders")
    assert bag(A.funder_metadata(small, path)) == bag(A.funder_metadata(small))


def test_institutions(small):
    assert bag(A.reg_institution(small)) == Counter(
        {(1, "North"): 1, (1, "South"): 2, (2, "Unaffiliated"): 1, (3, "Unaffiliated"): 1,
         (4, "Unaffiliated"): 1}
    )
    assert bag(A.reg_affiliated(small))[(1, "OSFI-Affiliate")] == 3
    assert bag(A.reg_institution(small, nodetype="node")) == Counter({(9, "North"): 1})


def test_template_takes_first_digit_run(small):
    assert bag(A.reg_template(small)) == Counter({(1, "Open-Ended"): 1, (2, "Cut"): 1,
                                                  (3, "Empty"): 1})


def test_provider_keeps_null(small):
    assert bag(A.reg_provider(small)) == Counter(
        {(1, "Main"): 1, (2, None): 1, (3, None): 1, (4, None): 1}
    )


def test_subjects(small):
    assert bag(A.reg_subject(small)) == Counter(
        {(1, "Biology"): 1, (1, "Botany"): 1, (2, "Botany"): 2, (3, "Unspecified"): 1,
         (4, "Unspecified"): 1}
    )
    # Registration 2 has lower subjects only; 3 has a subject nobody knows.
    assert bag(A.reg_subject_parent(small)) == Counter(
        {(1, "Biology"): 1, (3, "Unspecified"): 1, (4, "Unspecified"): 1}
    )


def test_creator_modes(small):
    nobody = [F.col("id") > 5]
    assert A.reg_creator(small, creator_sample=nobody).count() == 4
    assert A.reg_creator(small, creator_sample=nobody, creator_filter_mode="semi").count() == 0
    with pytest.raises(ValueError):
        A.reg_creator(small, creator_filter_mode="inner")


@pytest.mark.parametrize("names", [SUPPORTED_ATTRIBUTES, ("subject_parent",), ("funded", "subject")])
def test_tall_bag_equals_single_attributes(small, names):
    expected = Counter()
    for name in names:
        for (node_id, value), n in bag(A.ATTRIBUTE_OPERATORS[name](small)).items():
            expected[(node_id, name, value)] += n
    assert bag(A.assign_attributes(small, attributes=names)) == expected


def test_unknown_attributes(small):
    for names in (("colour",), ()):
        with pytest.raises(ValueError):
            A.assign_attributes(small, attributes=names)
