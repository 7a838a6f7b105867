import random
import re

import pytest
from pyspark.sql import functions as F

from tagmill.bounds import TooLarge
from tagmill.operators import longlists
from tagmill.operators import rules as R
from tagmill.operators.skew import spread_join
from tagmill.operators.visits import user_url_lists
from tagmill.plans.labels import product_labels, product_labels_of_visits

USERS = "distinct_id string, dollar_url_list array<string>"
RULES = "transfer_rule string, value string"


def pairs(df):
    return {tuple(r) for r in df.collect()}


def match(spark, users, rules, mode="contains", **how):
    cleaned = R.clean_rules(spark.createDataFrame(rules, RULES), mode)
    return pairs(R.match_rules(spark.createDataFrame(users, USERS), cleaned, **how))


def test_wildcards_are_dropped_and_underscore_is_literal(spark):
    users = [("u", ["a_b", "axb"])]
    assert match(spark, users, [("%a_b%", "lit"), ("a%xb", "glued"), ("A_B", "case")]) == {("u", "LIT"), ("u", "GLUED")}
    assert match(spark, [("u", ["axxb"])], [("a_b", "no"), ("a%b", "no")]) == set()


def test_needle_may_span_urls_in_row_scope_only(spark):
    users = [("u", ["ab", "cd"])]
    assert match(spark, users, [("%bc%", "x")]) == {("u", "X")}
    assert match(spark, users, [("%bc%", "x")], scope="url") == set()
    assert match(spark, users, [("%bc%", "x")], scope="url", dedupe=True) == set()


def test_null_and_empty_lists(spark):
    users = [("null", None), ("element", ["ab", None, "cd"]), ("empty", [])]
    assert match(spark, users, [("%bc%", "x")]) == {("element", "X")}
    assert match(spark, users, [("%", "all")]) == {("element", "ALL"), ("empty", "ALL")}


def test_labels_are_upper_cased_and_left_trimmed(spark):
    rules = [("a", "\t\x1d 　fr x "), ("a", None), (None, "y")]
    assert match(spark, [("u", ["a"])], rules) == {("u", "FR X ")}


def test_like_mode(spark):
    users = [("u", ["https://a.net/x.html"]), ("v", ["http://b.org/50%off"])]
    rules = [("https://%.net/%", "net"), ("%.html", "page"), ("%\\%off", "sale"), ("_ttp:%", "plain")]
    want = {("u", "NET"), ("u", "PAGE"), ("v", "SALE"), ("v", "PLAIN")}
    for how in ({}, {"strategy": "gram"}, {"scope": "url", "dedupe": True}, {"scope": "url", "strategy": "gram"}):
        assert match(spark, users, rules, "like", **how) == want


@pytest.mark.parametrize("scope", ["row", "url"])
@pytest.mark.parametrize("dedupe", [False, True])
@pytest.mark.parametrize("strategy", ["nested", "gram"])
def test_strategies_equal_brute_force(spark, monkeypatch, scope, dedupe, strategy):
    monkeypatch.setattr(R, "PIECE", 5)
    monkeypatch.setattr(R, "COARSE", 25)
    rnd = random.Random(7)
    word = lambda low, high: "".join(rnd.choice("abc/") for _ in range(rnd.randint(low, high)))
    users = [(f"u{i % 25}", [word(0, 30) for _ in range(rnd.randint(0, 6))]) for i in range(60)]
    texts = ["".join(urls) for _, urls in users if sum(map(len, urls)) > 20]
    rules = [(word(0, 6), f"l{i % 20}") for i in range(60)]
    for i, text in enumerate(texts):
        start = rnd.randint(0, len(text) - 16)
        rules.append((text[start : start + rnd.randint(5, 16)], f"m{i}"))
    want = set()
    for user, urls in users:
        for rule, value in rules:
            if any(rule in t for t in (["".join(urls)] if scope == "row" else urls)):
                want.add((user, value.upper()))
    assert match(spark, users, rules, scope=scope, dedupe=dedupe, strategy=strategy) == want


def test_unmatched_users_are_kept_on_request(spark):
    users = [("u", ["a"]), ("v", ["b"]), ("w", None)]
    for how in ({}, {"scope": "url"}, {"scope": "url", "dedupe": True}, {"strategy": "gram"}):
        got = match(spark, users, [("a", "x")], keep_unmatched=True, **how)
        assert {("u", "X"), ("v", None), ("w", None)} <= got
        assert {r for r in got if r[1]} == {("u", "X")}


def test_many_rules_leave_the_broadcast_copy(spark, monkeypatch):
    monkeypatch.setattr(R, "NESTED_RULES", 2)
    monkeypatch.setattr(R, "BROADCAST_RULES", 2)
    users = [("u", ["http://abc.example/def"])]
    rules = [("abc", "1"), ("def", "2"), ("xyz", "3"), ("example", "4")]
    assert match(spark, users, rules) == {("u", "1"), ("u", "2"), ("u", "4")}
    with pytest.raises(TooLarge):
        match(spark, users, rules, strategy="nested")


def test_spread_join_equals_join(spark):
    visits = [(f"u{i}", "hot" if i % 3 else f"t{i}") for i in range(300)]
    many = spark.createDataFrame(visits, "distinct_id string, text string")
    weights = many.groupBy("text").agg(F.count("*").alias("n"))
    few = weights.withColumn("label", F.explode(F.array(F.lit("a"), F.lit("b"))))
    got = spread_join(many, few, "text", "n", "distinct_id", task_rows=10)
    want = {(u, t, label) for u, t in visits for label in "ab"}
    assert got.count() == len(want)
    assert pairs(got.select("distinct_id", "text", "label")) == want


VISITS = "distinct_id string, seq bigint, url string"


def lists(df):
    out = {}
    for r in df.collect():
        assert (r.distinct_id, r.part) not in out
        out[r.distinct_id, r.part] = r.dollar_url_list
    return out


def test_heavy_users_get_consecutive_lists(spark):
    rows = [("hot", i, f"h{i}") for i in range(101)] + [(None, i, f"n{i}") for i in range(30)]
    rows += [("blank", i, "") for i in range(40)]
    rows += [("few", 2, "b"), ("few", 1, "a"), ("few", 3, None), ("none", 1, "")]
    random.Random(3).shuffle(rows)
    visits = spark.createDataFrame(rows, VISITS).repartition(5)
    got = lists(user_url_lists(visits, list_urls=10, overlap=0))
    hot = [f"h{i}" for i in range(101)]
    assert [got["hot", p] for p in range(11)] == [hot[p * 10 : p * 10 + 10] for p in range(11)]
    assert [u for p in range(3) for u in got[None, p]] == [f"n{i}" for i in range(30)]
    assert got["few", 0] == ["a", "b"] and got["none", 0] == [] and got["blank", 0] == []
    assert len(got) == 11 + 3 + 3


def test_cut_lists_match_like_whole_ones(spark):
    rnd = random.Random(11)
    rows = [
        (f"u{rnd.choice([0, 0, 0, 1, 2])}", i, "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 3))))
        for i in range(160)
    ]
    visits = spark.createDataFrame(rows, VISITS)
    texts = {u: "".join(x for k, _, x in rows if k == u) for u in ("u0", "u1", "u2")}
    needles = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    rules = spark.createDataFrame([(f"%{n}%", f"l{i}") for i, n in enumerate(needles)], RULES)
    empty = spark.createDataFrame([], "product_label string, product_label2 string")
    got = product_labels_of_visits(visits, rules, empty, list_urls=8)
    found = {(r.distinct_id, c) for r in got.collect() for c in got.columns[1:] if r[c]}
    assert found == {(u, f"L{i}") for u, t in texts.items() for i, n in enumerate(needles) if n in t}


DICTIONARY = "product_label string, product_label2 string"


def test_unknown_labels(spark):
    users = spark.createDataFrame([("u", ["ab"]), ("u", ["x"]), ("v", ["zz"])], USERS)
    rules = spark.createDataFrame([("a", "known"), ("x", "found"), ("q", "never"), ("zz", "known")], RULES)
    known = spark.createDataFrame([("Known", "1"), ("idle", "2")], DICTIONARY)
    rows = lambda **how: {r.distinct_id: r.asDict() for r in product_labels(users, rules, known, **how).collect()}
    want = {"distinct_id": "u", "IDLE": 0, "KNOWN": 1, "FOUND": 1}
    assert rows()["u"] == want and rows()["v"]["FOUND"] == 0
    assert rows(strategy="gram")["u"] == want
    assert "FOUND" not in rows(on_unknown="drop")["u"]
    with pytest.raises(ValueError, match="FOUND, NEVER"):
        rows(on_unknown="error")
    with pytest.raises(ValueError, match="clashes"):
        product_labels(users, rules, spark.createDataFrame([("Distinct_Id", "1")], DICTIONARY))


def test_more_labels_than_one_mask_holds(spark):
    labels = [f"L{i:03}" for i in range(200)]
    users = spark.createDataFrame([(f"u{i}", [f"<{i}>", f"<{(i * 7) % 200}>"]) for i in range(200)], USERS)
    rules = spark.createDataFrame([(f"<{i}>", v) for i, v in enumerate(labels)], RULES)
    got = product_labels(users, rules, spark.createDataFrame([(v, "") for v in labels], DICTIONARY))
    assert got.columns == ["distinct_id", *labels] and dict(got.dtypes)["L063"] == "bigint"
    for r in got.collect():
        i = int(r.distinct_id[1:])
        assert {c for c in labels if r[c]} == {labels[i], labels[i * 7 % 200]}


def test_flags_move_each_user_row_once(spark, capsys):
    users = spark.createDataFrame([("u", ["ab"])], USERS)
    rules = spark.createDataFrame([("a", "known")], RULES)
    product_labels(users, rules, spark.createDataFrame([("known", "1")], DICTIONARY)).explain()
    plan = capsys.readouterr().out
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Python" not in plan


def test_audit(spark):
    rules = [("%", "all"), ("a%b", "inner"), ("x", None), (None, "y"), ("z", "  ")]
    found = R.audit_rules(
        spark.createDataFrame(rules, RULES), spark.createDataFrame([("all", ""), ("idle", "")], DICTIONARY)
    )
    assert pairs(found) == {
        ("empty_needle", "%", "ALL"),
        ("inner_wildcard", "a%b", "INNER"),
        ("null_label", "x", None),
        ("null_rule", None, "Y"),
        ("blank_label", "z", ""),
        ("label_not_in_dictionary", None, "INNER"),
        ("label_not_in_dictionary", None, "Y"),
        ("label_not_in_dictionary", None, ""),
        ("label_without_rule", None, "IDLE"),
    }


def like(text, pattern):
    """LIKE by a regular expression of Python."""
    tokens = re.findall(r"(?s)\\.|.", pattern)
    known = {"%": ".*", "_": "."}
    return re.fullmatch("".join(known.get(t) or re.escape(t[-1]) for t in tokens), text, re.S) is not None


@pytest.mark.parametrize("composed", [500, 2])
def test_like_over_cut_lists(spark, monkeypatch, composed):
    """Parts of two or three URLs, patterns that span many of them, few characters so that hits overlap."""
    monkeypatch.setattr(longlists, "COMPOSED", composed)
    rnd = random.Random(composed)
    patterns = ["%", "_%", "%_", "ab%", "%ab", "a%b", "%a%b%a%", "%aa%aa%aa%", "aba", "___", r"%\%%", r"%a\_b%", "%a_b%b_a%", "%é%\n%", "%abab%bb", "b%bab%a_%b", "%%a%%", "ab%ab", "a%a"]
    patterns += ["%".join("".join(rnd.choice("ab_") for _ in range(rnd.randint(0, 3))) for _ in range(rnd.randint(2, 5))) for _ in range(30)]
    patterns = [p for p in dict.fromkeys(patterns) if p]
    visits, texts = [], {}
    for user in range(40):
        urls = ["".join(rnd.choice("aaabbb%_é\n") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.choice([1, 3, 4, 7, 12, 25]))]
        texts[user] = "".join(urls)
        visits += [(user, i, u) for i, u in enumerate(urls)]
    rules = R.clean_rules(spark.createDataFrame([(p, f"L{i}") for i, p in enumerate(patterns)], "transfer_rule string, value string"), "like")
    overlap = longlists.longest_segment(rules)
    df = spark.createDataFrame(visits, "distinct_id int, seq int, url string")
    lists = user_url_lists(df, list_urls=max(3, overlap), overlap=overlap)
    assert lists.where("part > 2").count()
    hits = longlists.match_cut_lists(lists, rules, key="distinct_id", list_urls=max(3, overlap), keep_unmatched=True)
    got = {(r.distinct_id, r.label) for r in hits.collect()}
    want = {(u, f"L{i}") for u, t in texts.items() for i, p in enumerate(patterns) if like(t, p)}
    assert {g for g in got if g[1]} == want and {g[0] for g in got} == set(texts)


def test_rules_that_share_a_needle_are_looked_up_by_their_edges(spark):
    """400 rules on two needles: a text meets the few with its own end or start, not all of its needle."""
    texts = [(f"{'ab'[i % 2]}-{i}-shared needle {i}", i) for i in range(200)]
    patterns = [f"%shared needle%{i}" for i in range(200)] + [f"_-{i}-shared%le%" for i in range(100)] + [f"a-{i}-%shared needle%" for i in range(100)]
    patterns += ["b%", "%9", "a-4-shared needle 4", "%", "%needle 7_", r"%needle\%5%", "x" * 40 + "%" + "y" * 40]
    texts += [("x" * 40 + "y" * 40, 200), ("x" * 39 + "y" * 40, 201), ("", 202), (None, 203)]
    df = spark.createDataFrame(texts, "t string, i int")
    rules = R.clean_rules(spark.createDataFrame([(p, f"L{n}") for n, p in enumerate(patterns)], RULES), "like")
    hits = [(r.i, r.label) for r in R.rule_hits(df, "t", rules, strategy="gram").collect()]
    assert sorted(hits) == sorted((i, f"L{n}") for t, i in texts if t is not None for n, p in enumerate(patterns) if like(t, p))
    shared = R._anchors(rules).groupBy("_kind", "_gram").count().agg(F.max("count")).first()[0]
    assert shared <= 100
