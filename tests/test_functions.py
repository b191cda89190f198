"""Scalar functions: coercion, names, keys, hashes, status text, labels."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from occspark.functions import coerce, keys, status, text
from occspark.operators.conservation import annotate_conservation
from occspark.schema import CONSERVATION_REFERENCE_FIELDS


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_clean_text_strips_every_white_space(spark):
    given = ["  a b\t", " x ", " \n ", "", None]
    assert column(spark, given, text.clean_text) == ["a b", "x", None, None, None]


def test_cells_become_text(spark):
    raw = [
        '{"c": "text"}',
        '{"c": ["a", null, "b", 3, ["x", "", "y"]]}',
        '{"c": {"b": 2, "a": 1}}',
        '{"c": "[1]"}',
        '{"c": true}',
        '{"c": null}',
        "{}",
    ]

    def cell(v):
        return coerce.cell_text(
            F.from_json(v, "c string")["c"],
            F.schema_of_variant(F.from_json(v, "c variant")["c"]),
        )

    wanted = ["text", "a | b | 3 | x | y", '{"b":2,"a":1}', "[1]", "True", None, None]
    assert column(spark, raw, cell) == wanted


def test_numbers_and_flags(spark):
    assert column(spark, ["1.25", "3", "", "no", None], coerce.to_double) == [1.25, 3.0, None, None, None]
    assert column(spark, ["7", " 9 ", "", "7.5", None], coerce.to_long) == [7, 9, None, None, None]
    flags = ["true", "T", "1", "yes", "Y", "false", "F", "0", "no", "N", "unknown", "", None]
    assert column(spark, flags, coerce.to_boolean) == [True] * 5 + [False] * 5 + [None] * 3


def test_json_number_truncates_where_text_does_not(spark):
    raw = ['{"c": 7.5}', '{"c": "7.5"}', '{"c": 7}', '{"c": "7"}']

    def year(v):
        return coerce.number_to_long(
            F.from_json(v, "c string")["c"], F.schema_of_variant(F.from_json(v, "c variant")["c"])
        )

    assert column(spark, raw, year) == [7, None, 7, 7]


def test_epoch_text_does_not_follow_the_session_zone(spark):
    given = ["0", "1000", "1500", "1301753096000", "soon", "", None]
    wanted = [
        "1970-01-01T00:00:00+00:00",
        "1970-01-01T00:00:01+00:00",
        "1970-01-01T00:00:01.500000+00:00",
        "2011-04-02T14:04:56+00:00",
        "soon",
        None,
        None,
    ]
    spark.conf.set("spark.sql.session.timeZone", "Australia/Melbourne")
    try:
        assert column(spark, given, coerce.millis_to_iso) == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_dates(spark):
    given = ["2008-10-01", " 2008-10-01/2008-10-05 ", "208", " ", None]
    assert column(spark, given, coerce.event_date_start)[:3] == ["2008-10-01", "2008-10-01", "208"]
    assert column(spark, given, coerce.event_date_end) == [None, "2008-10-05", None, None, None]
    assert column(spark, given, coerce.event_date_year) == [2008, 2008, None, None, None]


def test_names(spark):
    given = ["Ornitha (Lirida) vexans", "  Merula--ventis  ", None]
    assert column(spark, given, text.normalise_taxon_name) == ["ornitha vexans", "merula ventis", None]
    assert column(spark, ["Not / A  Key!", "__x__"], text.safe_key) == ["not_a_key", "x"]
    names = ["Ornitha (Lirida) vexans", "Ornitha", "Sarona Brevis x tumida", "", None]
    assert column(spark, names, text.binomial_genus) == ["Ornitha", "Ornitha", "Sarona", None, None]
    assert column(spark, names, text.binomial_species) == ["Ornitha vexans", None, "Sarona x", None, None]


def test_name_predicates(spark):
    given = [
        "Ornitha vexans",
        "Ornitha vexans vexans",
        "Ornitha Vexans",
        "Ornitha",
        "ornitha vexans",
        "Not supplied",
        "Unknown species",
        "Other values",
        "",
        None,
    ]
    loose = column(spark, given, text.is_probable_scientific_name)
    strict = column(spark, given, lambda c: text.is_probable_scientific_name(c, strict=True))
    facet = column(spark, given, text.is_valid_facet_label)
    assert loose == [True, True, True] + [False] * 7
    assert strict == [True, True] + [False] * 8
    assert facet == [True] * 5 + [False] * 5


@pytest.mark.parametrize(
    ("given", "level", "qualifier"),
    [
        ("Critically Endangered", "Critically Endangered", None),
        ("Endangered - northern form", "Endangered", "northern form"),
        ("Vulnerable;", "Vulnerable", None),
        ("Presumed Extinct", "Presumed Extinct", None),
        ("  ", None, None),
        (None, None, None),
    ],
)
def test_status_levels(spark, given, level, qualifier):
    assert column(spark, [given], status.status_level) == [level]
    assert column(spark, [given], status.status_qualifier) == [qualifier]


def test_state_status_picks_the_applicable_entry(spark):
    rows = [
        ("Queensland", "NSW: Critically Endangered; QLD: Vulnerable"),
        ("Victoria", "NSW: Rare"),
        ("Tasmania", "Endangered"),
        ("Overseas", "Endangered"),
        ("Overseas", "NSW: Rare"),
        (None, "QLD: Rare; Extinct"),
        ("Victoria", None),
    ]
    df = spark.createDataFrame(rows, "p string, s string")
    got = [tuple(r[0]) for r in df.select(status.state_status("p", "s")).collect()]
    assert got == [
        ("Vulnerable", "QLD: Vulnerable", "QLD", None),
        (None, None, None, None),
        ("Endangered", "TAS: Endangered", "TAS", None),
        ("Endangered", "Endangered", None, None),
        (None, None, None, None),
        ("Extinct", "Extinct", None, None),
        (None, None, None, None),
    ]


def test_json_text_equals_the_plain_encoder(spark):
    numbers = [0.0, -11.0, 1e7, 12345678.9, 1e15, 1e16, 1.5e17, 1e-4, 9.99e-5, -2.5e-10, 0.1 + 0.2, 1 / 3]
    assert column(spark, numbers, keys.json_number, "double") == [json.dumps(n) for n in numbers]
    texts = ['a"b\\c', "é\n", ""]
    assert column(spark, texts, keys.json_string) == [json.dumps(t, ensure_ascii=False) for t in texts]


def test_canonical_hash(spark):
    values = {
        "source": "s",
        "source_jurisdiction": None,
        "source_record_id": "7",
        "scientific_name": "A \"b\"",
        "event_date_start": "2008-10-01",
        "decimal_latitude": -33.0,
        "decimal_longitude": 150.25,
    }
    schema = ", ".join(f"{k} {'double' if 'decimal' in k else 'string'}" for k in values)
    df = spark.createDataFrame([tuple(values.values())], schema)
    payload = json.dumps(values, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert df.select(keys.canonical_hash()).first()[0] == hashlib.sha256(payload.encode()).hexdigest()


def test_labels(spark):
    shares = [0.7, 1.0, 0.0625, 0.3345, 0.0, 1 / 3, 0.9999]
    assert column(spark, shares, text.percent_text, "double") == [f"{s * 100:.1f}%" for s in shares]
    seconds = [3723.0, 62.5, 3.04]
    assert column(spark, seconds, text.duration_text, "double") == ["1h 2m 3.0s", "1m 2.5s", "3.0s"]
    assert column(spark, [1234567], text.count_text, "long") == ["1,234,567"]
    assert column(spark, [0.25, -0.25, 0.35], lambda c: keys.round_coordinate(c, 1), "double") == [0.3, -0.3, 0.4]
    even = column(spark, [0.25, -0.25, 0.35], lambda c: keys.round_coordinate(c, 1, True), "double")
    assert even == [0.2, -0.2, 0.4]


def test_list_items_keep_their_kind(spark):
    given = ['["[sic]","x"]', "[true,false,1]", '[[[["d"]]],"e"]', '[[true,"[f]"],null,""]']
    frame = spark.createDataFrame([(g,) for g in given], "t string")
    shown = coerce.cell_text(F.col("t"), F.schema_of_variant(F.parse_json("t")))
    assert [r[0] for r in frame.select(shown).collect()] == ["[sic] | x", "True | False | 1", "d | e", "True | [f]"]


def test_number_suffixes_are_no_numbers(spark):
    frame = spark.createDataFrame([("12d",), ("12f",), ("1.D",), ("12",), ("1e3",), ("inf",)], "t string")
    got = [r[0] for r in frame.select(coerce.to_double("t")).collect()]
    assert got == [None, None, None, 12.0, 1000.0, float("inf")]


def test_durations_round_ties_to_even(spark):
    frame = spark.createDataFrame([(0.25,), (0.75,), (59.97,), (3600.25,)], "s double")
    got = [r[0] for r in frame.select(text.duration_text("s")).collect()]
    assert got == ["0.2s", "0.8s", "60.0s", "1h 0m 0.2s"]


def test_iso_text_of_longs_is_not_parsed_and_stays_the_same(spark):
    from occspark.functions.coerce import millis_to_iso

    values = [(0,), (-1,), (1,), (946684799999,), (951782400000,), (-62135596800000,), (2**62,), (-(2**62),), (None,)]
    rows = spark.createDataFrame(values, "ms long").select(
        millis_to_iso("ms").alias("parsed"), millis_to_iso("ms", whole=True).alias("whole")
    )
    assert all(r["parsed"] == r["whole"] for r in rows.collect())
    plan = rows.select("whole")._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "cast(cast(ms" not in plan


def test_statuses_by_code_are_those_of_each_state(spark):
    given = [None, "", "Endangered", "NSW: Critically Endangered; QLD: Vulnerable", "VIC: Rare - under review; Extinct", "TAS:;x", ": a"]
    places = [None, "", " New South Wales ", "NSW", "Queensland", "Victoria", "Tasmania", "Overseas"]
    df = spark.createDataFrame([(s, p) for s in given for p in places], "s string, p string")
    by_code = status.statuses_by_code("s")
    rows = df.select(status.state_status("p", "s").alias("one"), status.status_in_state("p", by_code).alias("two")).collect()
    assert len(rows) == len(given) * len(places)
    assert [r["one"] for r in rows] == [r["two"] for r in rows]
    assert status._unknown({}) == "?"


def test_status_texts_are_not_taken_apart_for_every_record(spark):
    fields = CONSERVATION_REFERENCE_FIELDS
    reference = spark.range(1).select(*[F.lit("A b").alias(f) for f in fields])
    records = spark.range(3).select(*[F.lit("A b").alias(c) for c in ("scientificName", "species", "stateProvince")], "id")
    plan = annotate_conservation(records, reference)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" in plan and "lambdafunction" not in plan.split("Join")[0]


def test_strip_removes_what_the_class_of_white_space_has(spark):
    points = spark.range(0x3100).where("id < 55296").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    texts = points.select(F.concat("c", "c", F.lit("x y"), "c").alias("t"), F.lit("c"))
    plain = F.regexp_replace("t", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
    assert texts.where(text.strip("t") != plain).count() == 0
    assert texts.where(text.strip("t") == "x y").count() >= 29
