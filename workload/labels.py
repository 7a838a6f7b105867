"""URL rules, label snapshots and product tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions.text import clean_label, decode_label, needle, strip_blanks
from tagmill.operators.casetags import product_rules, with_tags
from tagmill.operators.flags import label_dictionary
from tagmill.operators.rules import audit_rules, clean_rules, match_rules
from tagmill.operators.visits import lists_for_rules, user_url_lists
from tagmill.plans.labels import label_snapshot, product_labels_of_visits, product_tag_partition
from tagmill.session import materialize, scratch_path
from tagmill.sinks.partitions import create_like, overwrite_table
from tagmill.sinks.runlog import read_log, replace_log
from tagmill.sources.tables import read_rule_map
from workload.inputs import dictionary, rule_map, scratch_table, small, table, visits, written

LIKE_RULES = [
    ("https://%.net/%", "secure net"),
    ("%/en/__5%", "ends in five"),
    ("%.html", "article"),
    ("%blog%", " blog"),
]

CODE_MAP = [
    ("Media & News", "url", "%/fr/ %", "romance", "news-01", "2024-01-01"),
    ("Media & News", "url", "%/es/%", "romance", "news-01", "2024-01-01"),
    ("Media & News", "url", "%utm_source=feed", "feed", "news-01", "2024-01-01"),
    ("Media&News", "url", "%blog%", "blog", "news-02", "2024-01-02"),
    ("Sites", "url", "%//m.%", "mobile", "site-01", "2024-01-03"),
    ("Sites", "url", "%//www.%", "mobile", "site-01", "2024-01-03"),
]
CODE_MAP_COLUMNS = ["product_label", "mapping_col", "transfer_rule", "value", "product_type", "dt"]


def _label_flags(spark, folder, **options):
    return product_labels_of_visits(visits(spark, folder), rule_map(spark), dictionary(spark), **options)


def product_label_flags(spark, folder):
    return _label_flags(spark, folder)


def product_label_flags_cut_lists(spark, folder):
    return _label_flags(spark, folder, list_urls=20)


def product_label_flags_url_scope(spark, folder):
    return _label_flags(spark, folder, scope="url", dedupe=True)


def product_label_flags_per_visit(spark, folder):
    return _label_flags(spark, folder, scope="url")


def product_label_flags_known_only(spark, folder):
    return _label_flags(spark, folder, on_unknown="drop", strategy="gram")


LONG_RULES = [
    ("https://%.net/%html%utm_source=%.net/%", "far apart"),
    ("%/fr/%/de/%/fr/%/en/%", "tour"),
    ("%#tophttps://%", "across"),
    ("https://%/en/__5%", "early"),
    ("%.com/%.html", "ends"),
    ("%blog%ref=x%blog%cheap-pills%", " blog"),
]


def product_label_flags_like_cut(spark, folder):
    """LIKE over each user's whole list, which is cut into parts of 30 URLs."""
    labels = small(spark, [(v.strip(), "L") for _, v in LONG_RULES] + [("unused", "U")], ["product_label", "product_label2"])
    return product_labels_of_visits(visits(spark, folder), rule_map(spark, LONG_RULES), labels, mode="like", list_urls=30)


def rule_match_pairs(spark, folder):
    rules = clean_rules(rule_map(spark))
    return match_rules(lists_for_rules(visits(spark, folder), rules), rules).distinct()


def rule_match_pairs_cut(spark, folder):
    """Lists of 20 URLs; a needle may stand across a cut."""
    rules = clean_rules(rule_map(spark))
    return match_rules(lists_for_rules(visits(spark, folder), rules, list_urls=20), rules).distinct()


def label_snapshot_files(spark, folder):
    """The label snapshot of a date on shared storage."""
    root = scratch_path(spark, "snapshots")
    rules = clean_rules(rule_map(spark))
    lists = lists_for_rules(visits(spark, folder), rules)
    name = label_snapshot(lists, rule_map(spark), dictionary(spark), root, "labels", "2024-01-31")
    return spark.read.parquet(f"{root}/{name}")


def rule_map_scan(spark, folder):
    """A rule map kept as a catalog table, rules repeated."""
    pages = visits(spark, folder)
    rules = pages.select(F.concat(F.lit("%//"), "distinct_id").alias("transfer_rule"), F.col("distinct_id").alias("value"), "seq")
    name, path = scratch_table(spark, "rule_map")
    create_like(spark, name, rules, path=path)
    overwrite_table(rules, name)
    found = materialize(read_rule_map(spark, name), "rule-map")
    spark.sql(f"DROP TABLE {name}")
    return found


def rule_match_like(spark, folder):
    single = visits(spark, folder).select("distinct_id", F.array("url").alias("dollar_url_list"))
    return match_rules(single, clean_rules(rule_map(spark, LIKE_RULES), "like"), scope="url").distinct()


def rule_match_grams(spark, folder):
    """A rule per site, so the rule map grows with the pages; users are page languages."""
    pages = visits(spark, folder)
    rules = pages.select(
        F.concat(F.lit("%//"), "distinct_id", F.lit("/%")).alias("transfer_rule"), F.col("distinct_id").alias("value")
    )
    users = pages.select(
        F.split_part("url", F.lit("/"), F.lit(4)).alias("distinct_id"), F.array("url").alias("dollar_url_list")
    )
    return match_rules(users, clean_rules(rules), scope="url", strategy="gram").distinct()


def rule_audit(spark, folder):
    pages, talk = table(spark, folder, "pages"), table(spark, folder, "conversations")
    lang = F.split_part("url", F.lit("/"), F.lit(4))
    rules = (
        pages.select(F.concat(F.lit("%/"), lang, F.lit("/%")).alias("transfer_rule"), lang.alias("value"))
        .unionAll(pages.select(F.regexp_replace("url", "[0-9]+", "%"), F.regexp_extract("url", r"[?#](.*)$", 1)))
        .unionAll(talk.select(F.lit("%"), F.nullif(F.col("role"), F.lit("system"))))
    )
    labels = (
        table(spark, folder, "documents").select(F.col("lang").alias("product_label"))
        .unionAll(table(spark, folder, "region").select("r_name"))
    )
    return audit_rules(rules, labels)


def _part_code_map(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_name").alias("product_label"),
        F.lit("p_type").alias("mapping_col"),
        F.concat(F.lit("% "), "p_type", F.lit(" %")).alias("transfer_rule"),
        F.col("p_brand").alias("value"),
        F.concat(F.lit("size-"), F.col("p_size").cast("string")).alias("product_type"),
        F.lit("2024-01-01").alias("dt"),
    )


def code_map_lookup(spark, folder):
    found = product_rules(_part_code_map(spark, folder), "Small__RING")
    return found.withColumn("transfer_rule", strip_blanks(F.col("transfer_rule")))


def label_dictionary_upper(spark, folder):
    part = table(spark, folder, "part")
    names = part.select(F.col("p_name").alias("product_label"), F.col("p_type").alias("product_label2"))
    return label_dictionary(names)


def _code_map(spark):
    return small(spark, CODE_MAP, CODE_MAP_COLUMNS)


def user_tag_case(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return with_tags(pages, product_rules(_code_map(spark), "Media___and___News"))


def user_tag_case_column_scope(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return with_tags(pages, product_rules(_code_map(spark), "Media___and___News"), scope="column")


def user_tags_by_lookup(spark, folder):
    """A rule per part and one per order of digits, some thousand in all, over names, brands and numbers of the parts."""
    part = table(spark, folder, "part")
    sku = F.concat_ws("-", "p_name", F.replace("p_brand", F.lit("#"), F.lit("_")), F.col("p_partkey").cast("string"))
    rows = part.select("p_partkey", sku.alias("sku"), F.col("p_type").alias("kind"))
    number = F.col("p_partkey").cast("string")
    rules = part.select(
        F.lit("sku").alias("mapping_col"),
        F.concat(F.lit("%"), F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit("-Brand__%"), number).alias("transfer_rule"),
        F.col("p_type").alias("value"),
    ).unionAll(
        part.select(F.lit("sku"), F.concat(F.lit("% -"), number, F.lit("%")), F.lit("dash"))
    ).unionAll(part.select(F.lit("kind"), F.concat(F.substring("p_type", 1, 3), F.lit("%")), F.substring("p_type", 1, 1)))
    return with_tags(rows, rules)


def tag_partition_overwrite(spark, folder):
    """Two products tag the pages; then the first runs again and keeps tagged rows only."""
    name, path = scratch_table(spark, "product_tag")
    log = scratch_path(spark, "run_log")
    pages = table(spark, folder, "pages").select("page_id", "url")
    run = {"run_date": "2024-01-05", "log_path": log, "process_time": "08:00:00", "path": path}
    tagged_only = "SELECT * FROM {tagged} WHERE user_tag IS NOT NULL AND dt < :run_date"
    product_tag_partition(pages, _code_map(spark), "sites", name, task_id="sites", **run)
    product_tag_partition(pages, _code_map(spark), "Media_and_News", name, task_id="media", **run)
    product_tag_partition(pages, _code_map(spark), "sites", name, task_id="sites", template=tagged_only, **run)
    return written(spark, name, path)


def run_log_replace(spark, folder):
    """A log row per event day and task: a first run counts twice, the repeated one only activity."""
    task = F.when(F.col("event_type") == "error", "errors").otherwise("activity")
    events = table(spark, folder, "events").withColumns({"run_date": F.to_date("ts"), "task_id": task})

    def entries(rows):
        return rows.groupBy("run_date", "task_id").agg(
            F.lit("dm_tag").alias("hive_db"),
            F.lit("events").alias("target_table"),
            F.count(F.lit(1)).alias("row_count"),
        )

    path = scratch_path(spark, "run_log")
    replace_log(entries(events.unionAll(events)), path)
    replace_log(entries(events.where(F.col("task_id") == "activity")), path)
    return read_log(spark, path)


def user_url_list(spark, folder):
    lists = user_url_lists(visits(spark, folder), list_urls=20, overlap=0)
    return lists.select(
        "distinct_id", "part", F.size("dollar_url_list").cast("bigint").alias("urls"),
        F.array_join("dollar_url_list", " ").alias("dollar_urls"),
    )


def text_functions(spark, folder):
    part = table(spark, folder, "part")
    code = F.concat_ws("_or_", F.concat_ws("_and_", F.replace("p_name", F.lit(" "), F.lit("__")), "p_type"), "p_brand")
    rule = F.concat(F.lit("%"), "p_name", F.lit(" %"), "p_type", F.lit("%"))
    return part.select(
        "p_partkey",
        decode_label(code).alias("decoded"),
        needle(rule).alias("needle"),
        strip_blanks(rule).alias("rule"),
        clean_label(F.concat(F.lit("\t 　"), "p_name", F.lit(" "))).alias("label"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        product_label_flags,
        product_label_flags_cut_lists,
        product_label_flags_url_scope,
        product_label_flags_per_visit,
        product_label_flags_known_only,
        product_label_flags_like_cut,
        rule_match_pairs,
        rule_match_pairs_cut,
        label_snapshot_files,
        rule_map_scan,
        rule_match_like,
        rule_match_grams,
        rule_audit,
        code_map_lookup,
        label_dictionary_upper,
        user_tag_case,
        user_tag_case_column_scope,
        user_tags_by_lookup,
        tag_partition_overwrite,
        run_log_replace,
        user_url_list,
        text_functions,
    )
}

_LISTS = """SELECT split_part(url, '/', 3) AS distinct_id, string_agg(url, '' ORDER BY page_id) AS t
FROM pages GROUP BY 1"""

_ROW_FLAGS = f"""SELECT distinct_id,
  contains(t, '.html')::BIGINT AS "ARTICLE",
  contains(t, 'utm_source=feed')::BIGINT AS "FEED",
  contains(t, '/fr/')::BIGINT AS "FRENCH",
  (contains(t, 'cheap-pills') OR contains(t, 'spam-farm'))::BIGINT AS "SPAM",
  contains(t, '#tophttps')::BIGINT AS "TOP_FIRST",
  0::BIGINT AS "UNUSED",
  contains(t, 'ref=x')::BIGINT AS "REF"
FROM ({_LISTS})"""

_URL_FLAGS = """SELECT split_part(url, '/', 3) AS distinct_id,
  max(contains(url, '.html')::BIGINT) AS "ARTICLE",
  max(contains(url, 'utm_source=feed')::BIGINT) AS "FEED",
  max(contains(url, '/fr/')::BIGINT) AS "FRENCH",
  max((contains(url, 'cheap-pills') OR contains(url, 'spam-farm'))::BIGINT) AS "SPAM",
  max(contains(url, '#tophttps')::BIGINT) AS "TOP_FIRST",
  0::BIGINT AS "UNUSED",
  max(contains(url, 'ref=x')::BIGINT) AS "REF"
FROM pages GROUP BY 1"""

_AUDIT = """WITH rules AS (
  SELECT '%/' || split_part(url, '/', 4) || '/%' AS transfer_rule, split_part(url, '/', 4) AS value FROM pages
  UNION SELECT regexp_replace(url, '[0-9]+', '%', 'g'), regexp_extract(url, '[?#](.*)$', 1) FROM pages
  UNION SELECT '%', nullif(role, 'system') FROM conversations),
labels AS (SELECT DISTINCT ltrim(upper(value)) AS label FROM rules WHERE value IS NOT NULL),
known AS (SELECT upper(lang) AS label FROM documents UNION SELECT upper(r_name) FROM region)
SELECT 'empty_needle' AS finding, transfer_rule, ltrim(upper(value)) AS label FROM rules
  WHERE replace(transfer_rule, '%', '') = ''
UNION ALL SELECT 'inner_wildcard', transfer_rule, ltrim(upper(value)) FROM rules
  WHERE contains(trim(transfer_rule, '%'), '%')
UNION ALL SELECT 'null_label', transfer_rule, NULL FROM rules WHERE value IS NULL
UNION ALL SELECT 'blank_label', transfer_rule, '' FROM rules WHERE ltrim(value) = ''
UNION ALL SELECT 'label_not_in_dictionary', NULL, label FROM labels WHERE label NOT IN (SELECT label FROM known)
UNION ALL SELECT 'label_without_rule', NULL, label FROM known WHERE label NOT IN (SELECT label FROM labels)"""

SQL = {
    "product_label_flags": _ROW_FLAGS,
    "product_label_flags_cut_lists": _ROW_FLAGS,
    "product_label_flags_url_scope": _URL_FLAGS,
    "product_label_flags_per_visit": _URL_FLAGS,
    "product_label_flags_known_only": f'SELECT * EXCLUDE ("REF") FROM ({_ROW_FLAGS})',
    "product_label_flags_like_cut": "SELECT distinct_id, "
    + ", ".join(f"""(t LIKE '{rule}')::BIGINT AS "{label.strip().upper()}\"""" for rule, label in LONG_RULES)
    + f', 0::BIGINT AS "UNUSED" FROM ({_LISTS})',
    "rule_match_pairs": f"""SELECT DISTINCT distinct_id, label FROM ({_LISTS}) u JOIN (VALUES
  ('/fr/', 'FRENCH'), ('utm_source=feed', 'FEED'), ('cheap-pills', 'SPAM'), ('spam-farm', 'SPAM'),
  ('examplenet', 'GLUED'), ('.html', 'ARTICLE'), ('#tophttps', 'TOP_FIRST'), ('ref=x', 'REF')) r(needle, label)
  ON contains(u.t, r.needle)""",
    "rule_match_like": """SELECT DISTINCT split_part(url, '/', 3) AS distinct_id, label FROM pages JOIN (VALUES
  ('https://%.net/%', 'SECURE NET'), ('%/en/__5%', 'ENDS IN FIVE'), ('%.html', 'ARTICLE'), ('%blog%', 'BLOG')
  ) r(pattern, label) ON url LIKE r.pattern""",
    "rule_match_grams": """SELECT DISTINCT split_part(p.url, '/', 4) AS distinct_id, upper(r.site) AS label
FROM pages p JOIN (SELECT DISTINCT split_part(url, '/', 3) AS site FROM pages) r
  ON contains(p.url, '//' || r.site || '/')""",
    "rule_audit": _AUDIT,
    "code_map_lookup": """SELECT p_name AS product_label, 'p_type' AS mapping_col,
  '%' || p_type || '%' AS transfer_rule, p_brand AS value, 'size-' || p_size AS product_type, '2024-01-01' AS dt
FROM part WHERE lower(p_name) = 'small ring'""",
    "label_dictionary_upper": "SELECT upper(p_name) AS product_label, p_type AS product_label2 FROM part",
    "user_tag_case": """SELECT page_id, url, CASE WHEN url LIKE '%utm_source=feed' THEN 'feed' END AS user_tag_1,
  CASE WHEN url LIKE '%/fr/%' THEN 'romance' WHEN url LIKE '%/es/%' THEN 'romance' END AS user_tag_2 FROM pages""",
    "user_tag_case_column_scope": """SELECT page_id, url,
  CASE WHEN url LIKE '%/fr/%' OR url LIKE '%/es/%' OR url LIKE '%utm_source=feed' THEN 'feed' END AS user_tag_1,
  CASE WHEN url LIKE '%/fr/%' OR url LIKE '%/es/%' OR url LIKE '%utm_source=feed' THEN 'romance' END AS user_tag_2
FROM pages""",
    "user_tags_by_lookup": """WITH s AS (
  SELECT p_partkey, p_name || '-' || replace(p_brand, '#', '_') || '-' || p_partkey AS sku, p_type AS kind FROM part),
r AS (SELECT DISTINCT '%' || split_part(p_name, ' ', 2) || '-Brand__%' || p_partkey AS rule, p_type AS tag FROM part
  UNION ALL SELECT '%-' || p_partkey || '%', 'dash' FROM part),
h AS (SELECT p_partkey, list(DISTINCT tag) AS tags FROM s JOIN r ON s.sku LIKE r.rule GROUP BY p_partkey)
SELECT s.p_partkey, sku, kind,
  """
    + ",\n  ".join(f"CASE WHEN kind LIKE '{v}%' THEN '{v}' END AS user_tag_{i}" for i, v in enumerate("ELMPS", 1))
    + ",\n  "
    + ",\n  ".join(
        f"CASE WHEN list_contains(tags, '{v}') THEN '{v}' END AS user_tag_{i}"
        for i, v in enumerate(("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "dash"), 6)
    )
    + " FROM s LEFT JOIN h USING (p_partkey)",
    "tag_partition_overwrite": """SELECT page_id, url, 'mobile' AS user_tag, '08:00:00' AS process_time,
  'site-01' AS product_type, '2024-01-03' AS dt FROM pages WHERE url LIKE '%//m.%' OR url LIKE '%//www.%'
UNION ALL SELECT page_id, url, CASE WHEN url LIKE '%blog%' THEN 'blog' END, '08:00:00', 'news-02', '2024-01-02'
FROM pages""",
    "run_log_replace": """SELECT CASE WHEN event_type = 'error' THEN 'errors' ELSE 'activity' END AS task_id,
  CAST(ts AS DATE) AS run_date, 'dm_tag' AS hive_db, 'events' AS target_table,
  CAST(sum(CASE WHEN event_type = 'error' THEN 2 ELSE 1 END) AS BIGINT) AS row_count FROM events GROUP BY 1, 2""",
    "user_url_list": """SELECT distinct_id, part, count(*) AS urls, string_agg(url, ' ' ORDER BY page_id) AS dollar_urls
FROM (SELECT split_part(url, '/', 3) AS distinct_id, page_id, url,
        (row_number() OVER (PARTITION BY split_part(url, '/', 3) ORDER BY page_id) - 1) // 20 AS part FROM pages)
GROUP BY distinct_id, part""",
    "text_functions": """SELECT p_partkey, p_name || '&' || p_type || '/' || p_brand AS decoded,
  p_name || ' ' || p_type AS needle, '%' || replace(p_name, ' ', '') || '%' || p_type || '%' AS rule,
  upper(p_name) || ' ' AS label FROM part""",
}

SQL["rule_match_pairs_cut"] = SQL["rule_match_pairs"]
SQL["label_snapshot_files"] = SQL["product_label_flags"]
SQL["rule_map_scan"] = """SELECT DISTINCT '%//' || split_part(url, '/', 3) AS transfer_rule, split_part(url, '/', 3) AS value
FROM pages"""
