from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from rillstone.functions import parse, similarity, text
from rillstone.operators import rules


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(("given", "want"), [("  a  b\tc ", "A B C"), ("", ""), (None, None)])
def test_normalize(spark, given, want):
    assert one(spark, given, text.normalize) == want


def test_first_last(spark):
    assert tuple(one(spark, "ada  byron king", text.first_last)) == ("ADA", "KING")
    assert one(spark, "ada", text.first_last) is None


@pytest.mark.parametrize(("given", "want"), [(" - ", "-"), (": x .", "x"), ("*", ""), (None, "")])
def test_clean_value(spark, given, want):
    assert one(spark, given, text.clean_value) == want


@pytest.mark.parametrize(("given", "want"), [("१२", 12), ("a1b2", 12), ("", None), ("x", None), ("9" * 30, None)])
def test_digits_int(spark, given, want):
    assert one(spark, given, text.digits_int) == want


def test_digits_repair(spark):
    assert one(spark, "l2O", text.digits_repair) == 120
    assert one(spark, "42", text.digits_repair) == 42


@pytest.mark.parametrize(("given", "want"), [("A8C12O", "ABC120"), ("AB", "AB"), ("0BCS1", "OBC51")])
def test_positional_repair(spark, given, want):
    assert one(spark, given, text.positional_repair) == want


def test_word_transform(spark):
    assert one(spark, "KARBHAR] Shaf|", text.word_transform) == "KARBHARI Shafl"


@pytest.mark.parametrize(("given", "want"), [("Fernale", "Female"), ("xyz", "xyz"), ("Malo", "Male"), (None, None)])
def test_vocab_snap(spark, given, want):
    assert one(spark, given, lambda c: text.vocab_snap(c, ["Male", "Female", "Third Gender"])) == want


def test_last_vocab_token(spark):
    assert one(spark, ["Male x", "an Fernale, y"], lambda c: text.last_vocab_token(c, ["Male", "Female"]), "array<string>") == "Female"


def test_fixpoint_strip_is_idempotent(spark):
    f = lambda c: text.fixpoint_strip(c, r"\s*(no\.?)?\s*[0-9]+$", ("ward",))
    assert one(spark, "oak hill no 2 7", f) == "oak hill"
    assert one(spark, "ward 12", f) == "ward 12"
    assert one(spark, "7 12", f) == "7 12"
    assert one(spark, one(spark, "oak hill no 2 7", f), f) == "oak hill"


def test_ranges_and_lists(spark):
    assert one(spark, "1-3, 7", text.range_list) == [1, 2, 3, 7]
    assert one(spark, None, text.range_list) == []
    assert one(spark, "5", text.range_list) == [5]
    assert one(spark, "1-50", text.integer_list) == [1, 50]


def test_keyword_cut(spark):
    assert one(spark, "a school b college c", lambda c: text.keyword_cut(c, ["school", "college"])) == "c"
    assert one(spark, "none", lambda c: text.keyword_cut(c, ["school"])) == ""


def test_clean_area_and_stem(spark):
    assert one(spark, "east school (old", lambda c: text.clean_area(c, ["school"])) == "east old"
    assert one(spark, "12.", lambda c: text.clean_area(c, ["school"])) == ""
    assert one(spark, "file:/a/b9/part_014.pdf", text.stem_number) == 14


def test_ratio_keeps_argument_order(spark):
    d = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    got = [r[0] for r in d.select(similarity.ratio("a", "b")).collect()]
    assert got == [SequenceMatcher(None, "tide", "diet").ratio(), SequenceMatcher(None, "diet", "tide").ratio(), None]


def test_length_bound_loses_no_match(spark):
    words = ["anna", "annabelle", "hanna", "bob", "an", ""]
    d = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for r in d.select("a", "b", similarity.may_match(F.col("a"), F.col("b"), 0.8).alias("m")).collect():
        assert r["m"] or SequenceMatcher(None, r["a"], r["b"]).ratio() < 0.8


def test_line_fold(spark):
    got = one(spark, ["Name: Ada", "Lovelace", "", "Age 36", "x"], lambda c: parse.line_fold(c, [("name", r"^Name:\s*(.*)$"), ("age", r"^Age\s*(\d+)$")]), "array<string>")
    assert got.asDict() == {"name": "Ada Lovelace", "age": "36 x"}


@pytest.mark.parametrize(("row", "want"), [((100, 40, 10, None), (60 * 0.5 + 40 * 0.05 + 30) / 1e6), ((None, None, None, 10), 30 / 1e6), ((10, 99, None, None), 0.5 / 1e6)])
def test_tiered_cost(spark, row, want):
    d = spark.createDataFrame([row], "i int, c int, o int, t int")
    assert d.select(parse.tiered_cost(F.col("i"), F.col("c"), F.col("o"), F.col("t"))).first()[0] == pytest.approx(want)


@pytest.mark.parametrize(("given", "want"), [('{"a": 0, "b": 5}', 0), ('{"a": true, "b": 5}', 5), ('{"a": "7"}', 7), ("{}", None)])
def test_json_number(spark, given, want):
    assert one(spark, given, lambda c: parse.json_number(c, "a", "b")) == want


def test_first_json(spark):
    assert one(spark, 'so: {"k": 3} done', lambda c: parse.first_json(c, "k int")["k"]) == 3


def test_identity_check(spark):
    d = spark.createDataFrame([(1, 2, None, 5), (1, 2, 3, 5), (1, 2, None, None), (4, 4, None, 5)], "a int, b int, c int, t int")
    third, ok = parse.identity_check([F.col("a"), F.col("b"), F.col("c")], F.col("t"))
    assert [tuple(r) for r in d.select(third, ok).collect()] == [(2, "Y"), (3, "N"), (None, "?"), (-3, "Y")]


def test_boxes(spark):
    d = spark.createDataFrame([("1,1,2,2", "0,0,4,4"), ("1,1,9,2", "0,0,4,4")], "i string, o string")
    assert [r[0] for r in d.select(parse.box_within(parse.unpack_box(F.col("i")), parse.unpack_box(F.col("o")))).collect()] == [True, False]


def test_rules(spark):
    d = spark.createDataFrame([("a", "91", "x"), ("b", "", "y"), ("c", "zz", None), ("d", "95", "name_bad")], "id string, conf string, flags string")
    pick = lambda rule: [r["id"] for r in d.where(rules.parse_rule(rule)).collect()]
    assert pick("conf<90") == ["b", "c"]
    assert pick("flags:bad") == ["d"]
    assert pick("conf<92,flags:bad") == ["a", "b", "c", "d"]
    assert len(pick("all")) == 4
    for bad in ("", "conf>3", "what"):
        with pytest.raises(ValueError):
            rules.parse_rule(bad)
