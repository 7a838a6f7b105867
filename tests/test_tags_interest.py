import pytest

from tagmill.functions.text import decode_label, unique_names
from tagmill.operators import casetags as C
from tagmill.operators import interest as I

CODE_MAP = ["product_label", "mapping_col", "transfer_rule", "value", "product_type", "dt"]


def code_map(spark, *rules):
    return spark.createDataFrame([("P & Q", *r, "t", "d") for r in rules], CODE_MAP)


def tags(spark, rules, values, scope="value"):
    df = C.with_tags(spark.createDataFrame([(v,) for v in values], "c string"), code_map(spark, *rules), scope)
    return [tuple(r)[1:] for r in df.collect()], df.columns[1:]


def test_labels_are_decoded_in_order():
    assert decode_label("Media___and___News") == "Media_ and _News".replace("_ and _", " & ")
    assert decode_label("a_and_b_or_c__d") == "a&b/c d"
    assert decode_label("Media__and__News") == "Media_&_News"


def test_product_lookup_ignores_case(spark):
    assert C.product_rules(code_map(spark, ("c", "x", "v")), "p___and___q").count() == 1


def test_one_pair_gives_user_tag(spark):
    got, names = tags(spark, [("c", "%a b%", "it's"), ("c", "%q'%", "it's")], ["xaby", "q'", "no", None])
    assert names == ["user_tag"]
    assert got == [("it's",), ("it's",), (None,), (None,)]


def test_several_pairs_are_numbered_and_scoped(spark):
    rules = [("c", "a%", "one"), ("c", "b%", "two")]
    assert tags(spark, rules, ["a", "b"]) == ([("one", None), (None, "two")], ["user_tag_1", "user_tag_2"])
    assert tags(spark, rules, ["a", "b"], "column")[0] == [("one", "two"), ("one", "two")]


def test_partition_must_be_single(spark):
    assert C.product_partition(code_map(spark, ("c", "x", "v"))) == ("t", "d")
    with pytest.raises(ValueError, match="no rule"):
        C.product_partition(code_map(spark, ("c", "x", "v")).limit(0))
    two = spark.createDataFrame([("p", "c", "x", "v", "t", d) for d in "12"], CODE_MAP)
    with pytest.raises(ValueError, match="share one"):
        C.product_partition(two)


DEGREES = "customuid string, interest_category string, degree string"
CLASSES = "customuid string, interest_category string, interest_class string"


def by_key(df):
    return {r.customuid: tuple(r)[1:] for r in df.collect()}


def degree_facts(spark):
    rows = [("u", "a", "low"), ("u", "a", "top"), ("u", "b", None), ("v", "b", "mid"), (None, "a", "x")]
    rows.append(("w", None, "z"))
    return spark.createDataFrame(rows, DEGREES)


def test_largest_degree_wins(spark, monkeypatch):
    want = {"u": ("top", ""), "v": ("", "mid"), None: ("x", ""), "w": ("", "")}
    got = I.degree_matrix(degree_facts(spark))
    assert got.columns == ["customuid", "大類_濃度_a", "大類_濃度_b"] and by_key(got) == want
    monkeypatch.setattr(I, "RANKED_DEGREES", 1)
    assert by_key(I.degree_matrix(degree_facts(spark))) == want
    assert by_key(I.degree_matrix(degree_facts(spark), categories=["b"])) == {k: v[1:] for k, v in want.items()}


def test_blocks_are_joined_on_both_sides(spark):
    classes = spark.createDataFrame([("u", "a", "k"), ("x", "a", "m"), (None, "a", "k"), ("x", "a", None)], CLASSES)
    assert by_key(I.class_flags(classes)) == {"u": ("1", "0"), "x": ("0", "1"), None: ("1", "0")}
    got = I.interest_wide(degree_facts(spark), classes)
    assert got.columns == ["customuid", "大類_濃度_a", "大類_濃度_b", "k", "m"]
    assert by_key(got) == {
        "u": ("top", "", "1", "0"),
        "v": ("", "mid", None, None),
        "w": ("", "", None, None),
        "x": (None, None, "0", "1"),
        None: ("x", "", "1", "0"),
    }
    filled = by_key(I.interest_wide(degree_facts(spark), classes, fill_absent=("-", "0")))
    assert filled["v"] == ("", "mid", "0", "0") and filled["x"] == ("-", "-", "0", "1")


def test_labels_that_differ_by_case_only(spark):
    assert unique_names(["a", "A", "b", "CUSTOMUID"], ["customuid"]) == ["a", "A_2", "b", "CUSTOMUID_2"]
    classes = spark.createDataFrame([("u", "a", "K"), ("v", "a", "k")], CLASSES)
    got = I.class_flags(classes)
    assert got.columns == ["customuid", "K", "k_2"] and by_key(got) == {"u": ("1", "0"), "v": ("0", "1")}
