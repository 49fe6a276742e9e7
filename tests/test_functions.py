from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from probity import functions as P
from probity.functions.identifiers import IDENTITY_NAMESPACE


def test_clean_money_follows_the_separator_rules(values):
    cases = {
        "S/ 1,200.00": 1200.0,
        "$500": 500.0,
        "1.200,50": 1200.5,
        "1.200": 1200.0,
        "12,5": 12.5,
        None: 0.0,
        "": 0.0,
        "abc": 0.0,
        "1,234,567.89": 0.0,
        "1.234.567,89": 0.0,
        "S/. 1,200.00": 0.0,
        "0.125": 125.0,
        "-5": 5.0,
    }
    assert values(P.clean_money, list(cases)) == list(cases.values())


def test_parse_money_reads_what_the_plain_rules_cannot(values):
    cases = {
        "1,234,567.89": 1234567.89,
        "1.234.567,89": 1234567.89,
        "1.234.567": 1234567.0,
        "S/. 1,200.00": 1200.0,
        "0.125": 0.125,
        "-5": -5.0,
        "S/ -1,5": -1.5,
        "1.200": 1200.0,
        "12,5": 12.5,
        "7.": 7.0,
        None: 0.0,
        "abc": 0.0,
    }
    assert values(P.parse_money, list(cases)) == list(cases.values())


def test_numbers_are_read_only_from_plain_numbers(values):
    texts = ["1.5", "1e3", " 1", "10d", "NaN", "x", None, "-2", ".5", "7."]
    assert values(P.to_double, texts) == [1.5, 1000.0, None, None, None, None, None, -2.0, 0.5, 7.0]
    assert values(P.to_long, ["3", "3.7", "99999999999999999999", None]) == [3, None, None, None]


def test_round_half_up_rounds_the_binary_value(values):
    assert values(lambda c: P.round_half_up(F.col(c), 2), [1.005, 2.675, 0.125], "double") == [1.0, 2.68, 0.13]


def test_national_id_is_padded_and_never_cut(values):
    cases = {None: "0" * 8, "1234567": "01234567", "1234567.0": "01234567", "123456789": "123456789"}
    assert values(P.normalize_national_id, list(cases)) == list(cases.values())


def test_tax_id_keeps_digits_and_null(values):
    cases = {" 20-100047218 ": "20100047218", "123": "00000000123", None: None, "123456789012": "123456789012"}
    assert values(P.normalize_tax_id, list(cases)) == list(cases.values())


def test_id_rules_reject_a_trailing_line_break(values):
    assert values(P.is_national_id, ["12345678", "12345678\n", "1234567a", None]) == [True, False, False, False]
    assert values(P.is_tax_id, [" 20100047218 ", "2010004721", "2010004721x", None]) == [True, False, False, False]


def test_text_is_folded_collapsed_and_cased(values):
    text = ["  José   Ñandú ", None]
    assert values(P.standardize_text, text) == ["JOSE ÑANDU", ""]
    assert values(lambda c: P.standardize_text(c, "none"), text) == ["Jose Ñandu", ""]
    assert values(lambda c: P.standardize_text(c, "title"), ["o'brien  GARCIA-lópez"]) == ["O'Brien Garcia-Lopez"]
    assert values(P.strip_spaces, ["  a  b \n"]) == ["a  b"]


def test_all_forty_vowels_fold(values):
    assert values(P.fold_accents, ["ÁÀÄÂÉÈËÊÍÌÏÎÓÒÖÔÚÙÜÛ", "áàäâéèëêíìïîóòöôúùüû", "Ñç"]) == [
        "AAAAEEEEIIIIOOOOUUUU",
        "aaaaeeeeiiiioooouuuu",
        "Ñç",
    ]


@pytest.mark.parametrize(
    ("name", "norm"),
    [
        ("Andina, S.A.C.", "ANDINA"),
        ("SAN ANTONIO SRLTDA", "SAN ANTONIO"),
        ("SACOS SA", "SACOS"),
        ("Minera S C R L Norte", "MINERA NORTE"),
        ("ÑSA", "ÑSA"),
        (None, None),
    ],
)
def test_company_names_lose_legal_forms_as_whole_words_only(values, name, norm):
    assert values(P.normalize_company, [name]) == [norm]


def test_uuid5_equals_the_standard_library(values):
    seeds = ["12345678", "ñandú|x", "", "a" * 200]
    expected = [str(uuid.uuid5(uuid.UUID(IDENTITY_NAMESPACE), seed)) for seed in seeds]
    assert values(P.uuid5, seeds) == expected
    assert expected[:2] == ["cf8dc092-4896-59a5-aa3d-0064d98dcfa4", "0efec7e1-98e2-5954-90d0-966b38f84684"]


def test_global_id_uses_the_natural_key_without_a_proper_id(spark):
    rows = spark.createDataFrame(
        [("12345678", "k"), ("123", "k"), (None, "k"), ("1234567x", None)], "d string, k string"
    )
    ids = [r[0] for r in rows.select(P.global_id("d", "k")).collect()]
    space = uuid.UUID(IDENTITY_NAMESPACE)
    assert ids == [str(uuid.uuid5(space, seed)) for seed in ("12345678", "k", "k", "")]


def test_natural_key_keeps_empty_parts(spark):
    key = spark.range(1).select(P.natural_key(F.lit("a"), F.lit(None).cast("string"), F.lit("c")))
    assert key.first()[0] == "a||c"


def test_list_measures(values):
    kind = "array<struct<v: string, s: string, y: string>>"
    lists = [
        None,
        [],
        [("1.5", "Sector PUBLICO", "3"), ("x", "publico", None)],
        [("2", "PÚBLICO", "4"), ("1e1", None, "9"), (None, "publico", "3.7")],
    ]
    assert values(P.list_count, lists, kind) == [0, 0, 2, 3]
    assert values(lambda c: P.list_sum(c, "v"), lists, kind) == [0.0, 0.0, 1.5, 12.0]
    assert values(lambda c: P.public_experience(c, "s", "y"), lists, kind) == [0, 0, 4, 0]
    assert values(lambda c: P.public_experience(c, "s", "y", True), lists, kind) == [0, 0, 4, 4]


def test_lists_for_output_hold_no_null(values):
    assert values(P.without_nulls, [None, [None, "a"], []], "array<string>") == [[], ["a"], []]
    nested = [None, [["a", None], None, ["b"]]]
    assert values(lambda c: P.without_nulls(c, True), nested, "array<array<string>>") == [[], ["a", "b"]]


def test_supplier_page(values):
    assert values(P.supplier_page, ["20100047218"]) == [
        "https://apps.osce.gob.pe/perfilprov-ui/ficha/20100047218"
    ]


def test_context_joins_all_dimensions(spark):
    text = spark.range(1).select(P.join_context(F.lit("a"), F.lit(None).cast("string"), F.lit("c")))
    assert text.first()[0] == "a \n  \n c"
