"""The ontology: entity types, relations, endpoint constraints and shapes, as data.

Fixed values throughout: results must use these codes and labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SITE, GROUP, PERSON, ARTIFACT, EVENT = "E27_Site", "E74_Group", "E21_Person", "E22_Man-Made_Object", "E5_Event"
PLACE, PERIOD, DOCUMENT, DISCOVERY = "E53_Place", "E52_Time-Span", "E31_Document", "S19_Encounter_Event"

#: (code, label, id prefix, category), in declared order
TYPES = (
    (SITE, "Archaeological Site", "site", "Sites"),
    (GROUP, "Cultural Group", "group", "Peoples & Cultures"),
    (PERSON, "Person", "person", "Persons"),
    (ARTIFACT, "Artifact", "artifact", "Artifacts"),
    (EVENT, "Event", "event", "Events"),
    (PLACE, "Place", "place", "Places"),
    (PERIOD, "Time Period", "period", "Time Periods"),
    (DOCUMENT, "Document", "doc", None),
    (DISCOVERY, "Discovery Event", "discovery", "Events"),
)
LABELS = {code: label for code, label, _, _ in TYPES}
PREFIXES = {code: prefix for code, _, prefix, _ in TYPES}
CATEGORY = {code: category for code, _, _, category in TYPES if category}
#: In the order of the sidebar.
CATEGORIES = ("Peoples & Cultures", "Persons", "Sites", "Places", "Events", "Time Periods", "Artifacts")
OTHER = "Other"
#: Types that a model doesn't propose.
NOT_PROPOSED = (DOCUMENT, DISCOVERY)

#: (relation, display label, source types, target types); no target types: the target is free text
RELATIONS = (
    ("P53_HAS_FORMER_OR_CURRENT_LOCATION", "located in", (SITE, GROUP, ARTIFACT), (PLACE, SITE)),
    ("HAS_CULTURAL_AFFILIATION", "affiliated with", (SITE,), (GROUP,)),
    ("P107I_IS_CURRENT_OR_FORMER_MEMBER_OF", "member of", (PERSON, GROUP), (GROUP,)),
    ("P4_HAS_TIME-SPAN", "dated to", (SITE, GROUP, ARTIFACT, EVENT, DISCOVERY, DOCUMENT), (PERIOD,)),
    ("P8_TOOK_PLACE_ON_OR_WITHIN", "took place in", (EVENT, DISCOVERY), (PLACE, SITE)),
    ("P11_HAD_PARTICIPANT", "involved", (EVENT,), (PERSON, GROUP)),
    ("O19_HAS_FOUND_OBJECT", "found", (DISCOVERY,), (ARTIFACT,)),
    ("P14_CARRIED_OUT_BY", "carried out by", (DISCOVERY, DOCUMENT), (PERSON,)),
    ("P70I_IS_DOCUMENTED_IN", "documented in", (SITE, GROUP, PERSON, ARTIFACT, EVENT, DISCOVERY), (DOCUMENT,)),
    ("P89_FALLS_WITHIN", "within", (PLACE,), (PLACE,)),
    ("P45_CONSISTS_OF", "made of", (ARTIFACT,), ()),
    ("P101_HAD_AS_GENERAL_USE", "used as", (ARTIFACT,), ()),
    ("MENTIONS", "mentions", ("Chunk",), tuple(LABELS)),
    ("FROM_DOCUMENT", "from document", ("Chunk",), (DOCUMENT,)),
)
DISPLAY = {name: shown for name, shown, _, _ in RELATIONS}
PROPERTIES = ("P45_CONSISTS_OF", "P101_HAD_AS_GENERAL_USE")
INFRASTRUCTURE = ("MENTIONS", "FROM_DOCUMENT")
EXTRACTABLE = tuple(name for name, *_ in RELATIONS if name not in INFRASTRUCTURE)
CONFIDENCE_FLOOR = 0.5
MERGE_AT, FLAG_AT = 0.85, 0.75

#: Shapes: (type, path, kind, minimum, maximum, allowed values or target types).  kind: literal or object
SHAPES = (
    (SITE, "name", "literal", 1, 1, ()),
    (SITE, "P3_has_note", "literal", 0, 1, ()),
    (SITE, "P53_HAS_FORMER_OR_CURRENT_LOCATION", "object", 0, 1, (PLACE,)),
    (SITE, "P70I_IS_DOCUMENTED_IN", "object", 0, None, (DOCUMENT,)),
    (SITE, "P4_HAS_TIME-SPAN", "object", 0, None, (PERIOD,)),
    (SITE, "HAS_CULTURAL_AFFILIATION", "object", 0, None, (GROUP,)),
    (GROUP, "name", "literal", 1, 1, ()),
    (GROUP, "P3_has_note", "literal", 0, 1, ()),
    (GROUP, "P2_has_type", "literal", 0, 1, ("tribe", "confederacy", "nation", "band", "chiefdom", "linguistic group")),
    (GROUP, "P53_HAS_FORMER_OR_CURRENT_LOCATION", "object", 0, None, (PLACE,)),
    (GROUP, "P107I_IS_CURRENT_OR_FORMER_MEMBER_OF", "object", 0, None, (GROUP,)),
    (GROUP, "P4_HAS_TIME-SPAN", "object", 0, None, (PERIOD,)),
    (GROUP, "P70I_IS_DOCUMENTED_IN", "object", 0, None, (DOCUMENT,)),
    (PERSON, "name", "literal", 1, 1, ()),
    (PERSON, "P3_has_note", "literal", 0, 1, ()),
    (PERSON, "P107I_IS_CURRENT_OR_FORMER_MEMBER_OF", "object", 0, None, (GROUP,)),
    (PERSON, "P70I_IS_DOCUMENTED_IN", "object", 0, None, (DOCUMENT,)),
    (ARTIFACT, "name", "literal", 1, 1, ()),
    (ARTIFACT, "P3_has_note", "literal", 0, 1, ()),
    (ARTIFACT, "P101_HAD_AS_GENERAL_USE", "literal", 0, 1, ()),
    (ARTIFACT, "P45_CONSISTS_OF", "literal", 0, None, ()),
    (ARTIFACT, "P53_HAS_FORMER_OR_CURRENT_LOCATION", "object", 0, 1, (SITE,)),
    (ARTIFACT, "P4_HAS_TIME-SPAN", "object", 0, None, (PERIOD,)),
    (ARTIFACT, "P70I_IS_DOCUMENTED_IN", "object", 0, None, (DOCUMENT,)),
    (EVENT, "name", "literal", 1, 1, ()),
    (EVENT, "P3_has_note", "literal", 0, 1, ()),
    (EVENT, "P2_has_type", "literal", 0, 1, ()),
    (EVENT, "P8_TOOK_PLACE_ON_OR_WITHIN", "object", 1, None, (PLACE, SITE)),
    (EVENT, "P4_HAS_TIME-SPAN", "object", 1, 1, (PERIOD,)),
    (EVENT, "P11_HAD_PARTICIPANT", "object", 0, None, (PERSON, GROUP)),
    (EVENT, "P70I_IS_DOCUMENTED_IN", "object", 0, None, (DOCUMENT,)),
    (PLACE, "name", "literal", 1, 1, ()),
    (PLACE, "P3_has_note", "literal", 0, 1, ()),
    (PLACE, "P2_has_type", "literal", 0, 1, ("river", "valley", "mountain", "region", "bay", "island", "piedmont", "coastal plain")),
    (PLACE, "P89_FALLS_WITHIN", "object", 0, 1, (PLACE,)),
    (PERIOD, "name", "literal", 1, 1, ()),
    (PERIOD, "P82a_begin_of_the_begin", "literal", 0, 1, ()),
    (PERIOD, "P82b_end_of_the_end", "literal", 0, 1, ()),
    (PERIOD, "P3_has_note", "literal", 0, 1, ()),
    (DOCUMENT, "name", "literal", 1, 1, ()),
    (DOCUMENT, "P2_has_type", "literal", 0, 1, ("monograph", "journal article", "report", "thesis", "book chapter")),
    (DOCUMENT, "P14_CARRIED_OUT_BY", "object", 0, None, (PERSON,)),
    (DOCUMENT, "P4_HAS_TIME-SPAN", "object", 0, 1, (PERIOD,)),
    (DISCOVERY, "P2_has_type", "literal", 0, 1, ()),
    (DISCOVERY, "P14_CARRIED_OUT_BY", "object", 0, None, (PERSON,)),
    (DISCOVERY, "O19_HAS_FOUND_OBJECT", "object", 0, None, (ARTIFACT,)),
    (DISCOVERY, "P8_TOOK_PLACE_ON_OR_WITHIN", "object", 0, 1, (SITE,)),
    (DISCOVERY, "P4_HAS_TIME-SPAN", "object", 0, 1, (PERIOD,)),
    (DISCOVERY, "P70I_IS_DOCUMENTED_IN", "object", 0, None, (DOCUMENT,)),
)


def type_spellings() -> dict[str, str]:
    """Each accepted spelling of a type -> its code: the code, the label, the code without its prefix."""
    out: dict[str, str] = {code: code for code in LABELS}
    for code, label in LABELS.items():
        for spelling in (label, code.split("_", 1)[1]):
            out.setdefault(spelling, code)
    return out


def types_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, label, p, g or OTHER) for c, label, p, g in TYPES], "type string, label string, prefix string, category string")


def relations_table(spark: SparkSession) -> DataFrame:
    rows = [(n, d, list(s), list(t), n in PROPERTIES, n in EXTRACTABLE) for n, d, s, t in RELATIONS]
    return spark.createDataFrame(rows, "rel_type string, display string, sources array<string>, targets array<string>, is_property boolean, extractable boolean")


def shapes_table(spark: SparkSession) -> DataFrame:
    rows = [(s, p, k, a, b, list(v)) for s, p, k, a, b, v in SHAPES]
    return spark.createDataFrame(rows, "shape string, path string, kind string, min_count int, max_count int, allowed array<string>")
