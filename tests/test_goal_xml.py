"""Goal documents."""

import xml.etree.ElementTree as ET

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline import plans

from tests.league import rows


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, start=1)), "match_api_id BIGINT, goal STRING")


def goal(stats=None, **tags):
    inner = "".join(f"<{k}>{v}</{k}>" for k, v in tags.items())
    return f"<value>{inner}{stats or ''}</value>"


CLASSES = {
    "<stats><goals>1</goals><shoton>1</shoton></stats>": "normal",
    "<stats><shoton/><goals/></stats>": "normal",
    "<stats><goals>1</goals><shoton>1</shoton><penalty>1</penalty></stats>": "normal",
    "<stats><goals>1</goals><penalty>1</penalty></stats>": "penal en juego",
    "<stats><goals>1</goals><penalty>1</penalty><penalties>1</penalties></stats>": "penal en juego",
    "<stats><penalties>1</penalties></stats>": "penal por desempate",
    "<stats><goals>1</goals><penalties>1</penalties><owngoals>1</owngoals></stats>": "penal por desempate",
    "<stats><owngoals>1</owngoals></stats>": "contragol",
    "<stats><goals>1</goals></stats>": "unknown",
    "<stats><shoton>1</shoton><penalty>1</penalty></stats>": "unknown",
    "<stats><corners>1</corners></stats>": "unknown",
    "<stats/>": "unknown",
    "": "-",
}


def test_types(spark):
    text = "<goal>" + "".join(goal(s, id=i) for i, s in enumerate(CLASSES)) + "</goal>"
    found = plans.explode_goal_xml(documents(spark, text)).collect()
    assert {r.ID_Gol: r.Tipo for r in found} == dict(enumerate(CLASSES.values()))


def test_players_subtypes_and_ids(spark):
    text = (
        "<goal>"
        + goal(id=1, player1=7, subtype="header")
        + goal(id=2)
        + "<value><id>3</id><player1/><subtype/></value>"
        + "<value><id>4</id><id>5</id><player1>x</player1></value>"
        + "<other><value><id>6</id></value></other></goal>"
    )
    assert rows(plans.explode_goal_xml(documents(spark, text), players="null")) == [
        (1, 1, 7, "-", "header"), (2, 1, None, "-", "-"), (3, 1, None, "-", None), (5, 1, None, "-", "-"),
    ]


def test_every_row_is_flattened_and_copies_are_not(spark):
    twice = "<goal>" + goal(id=1) * 2 + "</goal>"
    df = documents(spark, twice, None, "<goal/>", "<goal></goal>", twice)
    copied = df.union(df)
    assert rows(plans.explode_goal_xml(copied).select("ID_Partido", "ID_Gol")) == [(1, 1), (1, 1), (5, 1), (5, 1)]


BAD = ["<goal><value>", "", "no xml", "<other><value><id>3</id></value></other>"]


@pytest.mark.parametrize("text", BAD)
def test_malformed_documents_stop_the_job(spark, text):
    with pytest.raises(Exception, match="malformed goal document of match 1"):
        plans.explode_goal_xml(documents(spark, text)).collect()


def test_malformed_documents_can_be_skipped_and_listed(spark):
    good = '<?xml version="1.0"?>\n<!-- a\nb --> <goal>' + goal(id=9) + "</goal>"
    df = documents(spark, *BAD, good, None)
    assert rows(plans.explode_goal_xml(df, malformed="skip")) == [(9, 5, None, "-", "-")]
    assert [r[0] for r in rows(plans.malformed_goal_documents(df))] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        plans.explode_goal_xml(df, malformed="ignore")


TAGS = ("goals", "shoton", "penalty", "penalties", "owngoals", "other")
GOALS = st.lists(
    st.tuples(
        st.integers(1, 10**12),
        st.one_of(st.none(), st.integers(1, 10**6)),
        st.one_of(st.none(), st.sampled_from(["header", "a & b", "volley <x>"])),
        st.one_of(st.none(), st.sets(st.sampled_from(TAGS))),
    ),
    max_size=5,
)


def as_text(found):
    root = ET.Element("goal")
    for number, player, subtype, stats in found:
        value = ET.SubElement(root, "value")
        ET.SubElement(value, "id").text = str(number)
        if player is not None:
            ET.SubElement(value, "player1").text = str(player)
        if subtype is not None:
            ET.SubElement(value, "subtype").text = subtype
        if stats is not None:
            box = ET.SubElement(value, "stats")
            for tag in sorted(stats):
                ET.SubElement(box, tag).text = "1"
    return ET.tostring(root, encoding="unicode")


def expected_type(stats):
    if stats is None:
        return "-"
    for needed, kind in (
        ({"goals", "shoton"}, "normal"),
        ({"goals", "penalty"}, "penal en juego"),
        ({"penalties"}, "penal por desempate"),
        ({"owngoals"}, "contragol"),
    ):
        if needed <= stats:
            return kind
    return "unknown"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(GOALS, min_size=1, max_size=20))
def test_written_documents_are_read_back(spark, matches):
    found = rows(plans.explode_goal_xml(documents(spark, *map(as_text, matches))))
    expected = [
        (number, match, player, expected_type(stats), "-" if subtype is None else subtype)
        for match, found_goals in enumerate(matches, start=1)
        for number, player, subtype, stats in found_goals
    ]
    assert found == sorted(expected, key=repr)


def _goal(number, player="7"):
    return f"<value><id>{number}</id><player1>{player}</player1><stats><goals>1</goals></stats></value>"


def test_exactly_one_root_and_readable_goal_ids(spark):
    import pytest

    from touchline.plans.staging import explode_goal_xml, malformed_goal_documents

    one = f"<goal>{_goal(1)}</goal>"
    good = {
        1: one,
        2: "﻿" + '<?xml version="1.0"?> <!-- c --> ' + one + " \n<!-- d -->",
        3: "<goal/>",
        4: f"<goal>{_goal(2, '')}</goal>",
        5: "<goal><value><id>3</id><subtype> a b </subtype></value></goal>",
    }
    bad = {
        11: one + one,
        12: one + " more",
        13: "<!DOCTYPE goal>" + one,
        14: f"<goal>{_goal('G-4')}</goal>",
        15: f"<goal>{_goal('9' * 20)}</goal>",
        16: "<card/>",
        17: "",
    }
    docs = spark.createDataFrame([*good.items(), *bad.items()], "match_api_id long, goal string")
    kept = explode_goal_xml(docs, malformed="skip").collect()
    assert sorted((r.ID_Partido, r.ID_Gol, r.ID_Jugador or 0) for r in kept) == [(1, 1, 7), (2, 1, 7), (4, 2, 0), (5, 3, 0)]
    assert [r.Subtipo for r in kept if r.ID_Gol == 3] == [" a b "]
    assert sorted(r.match_api_id for r in malformed_goal_documents(docs).collect()) == sorted(bad)
    for number in bad:
        with pytest.raises(Exception, match=f"malformed goal document of match {number}"):
            explode_goal_xml(docs.where(f"match_api_id = {number}")).collect()


def test_ids_of_players_that_are_no_numbers(spark):
    text = "<goal>" + _goal(1, "P-7") + _goal(2, " 8 ") + _goal(3, "") + "</goal>"
    df = documents(spark, text)
    with pytest.raises(Exception, match="malformed goal document"):
        plans.explode_goal_xml(df).collect()
    assert plans.malformed_goal_documents(df).count() == 1
    assert plans.malformed_goal_documents(df, players="text").count() == 0
    found = plans.explode_goal_xml(df, players="text").select("ID_Gol", "ID_Jugador")
    assert rows(found) == [(1, "P-7"), (2, "8"), (3, None)]
    found = plans.explode_goal_xml(df, players="null").select("ID_Gol", "ID_Jugador")
    assert rows(found) == [(1, None), (2, 8), (3, None)]
    assert plans.explode_goal_xml(df, malformed="skip").count() == 0
    with pytest.raises(ValueError):
        plans.explode_goal_xml(df, players="drop")
