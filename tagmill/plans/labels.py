"""Label snapshots, product tags and the interest table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.bounds import bounded_values, held
from tagmill.operators.casetags import product_partition, product_rules, with_tags
from tagmill.operators.flags import (
    MAX_LABELS,
    dictionary_labels,
    flag_columns,
    labels_present,
    merge_masks,
    with_masks,
)
from tagmill.operators.interest import interest_wide
from tagmill.operators.longlists import longest_segment, match_cut_lists
from tagmill.operators.rules import NESTED_RULES, clean_rules, match_rules
from tagmill.operators.visits import LIST_URLS, lists_for_rules, user_url_lists
from tagmill.session import materialize
from tagmill.sinks.jdbc import write_snapshot
from tagmill.sinks.partitions import create_like, overwrite_partitions
from tagmill.sinks.runlog import log_run
from tagmill.sources.jdbc import Connection
from tagmill.sources.tables import run_template

# Rules read once to the driver and kept there; a larger map stays a DataFrame.
HELD_RULES = 10_000

# Published name of the interest table, before its date (fixed value).
INTEREST_TABLE = "興趣_大類_濃度及細類"


def product_labels(
    users: DataFrame,
    rules: DataFrame,
    dictionary: DataFrame,
    *,
    mode: str = "contains",
    on_unknown: str = "add",
    key: str = "distinct_id",
    match=match_rules,
    **matching,
) -> DataFrame:
    """Label snapshot: one row per user, one 0/1 column per label.

    Labels of the dictionary are always columns.  ``on_unknown`` decides on other
    labels of the rule map: ``add`` a column for each that some user has, ``drop``
    them, or raise an ``error``.  Which of them to add is read off the masks, which
    are written aside for it, so the texts are matched once.  ``matching`` goes to
    ``match``, by default ``match_rules``.
    """
    if on_unknown not in ("add", "drop", "error"):
        raise ValueError(f"on_unknown {on_unknown!r}")
    labels = dictionary_labels(dictionary)
    cleaned, held_rows = held(clean_rules(rules, mode), HELD_RULES)
    strange = []
    if on_unknown != "drop":
        if held_rows is not None:
            named = {row.label for row in held_rows}
        else:
            named = set(bounded_values(cleaned, "label", MAX_LABELS, "labels of the rule map"))
        strange = sorted(named - set(labels))
        if strange and on_unknown == "error":
            raise ValueError(f"labels outside the dictionary: {', '.join(strange)}")
    few = held_rows is not None and len(held_rows) <= NESTED_RULES
    if matching.get("strategy", "auto") == "auto":
        matching["strategy"] = "nested" if few else "gram"
    every = labels + strange
    hits = match(
        users, with_masks(cleaned, every), key=key, keep_unmatched=True, counted=few, **matching
    )
    merged = merge_masks(hits, key, every)
    if strange:
        merged = materialize(merged, "label-masks")
        found = labels_present(merged, every)
        labels = labels + [v for v in strange if v in found]
    return flag_columns(merged, key, every, labels)


def product_labels_of_visits(
    visits: DataFrame,
    rules: DataFrame,
    dictionary: DataFrame,
    *,
    key: str = "distinct_id",
    order: str = "seq",
    url: str = "url",
    list_urls: int = LIST_URLS,
    **options,
) -> DataFrame:
    """``product_labels`` from single visits, as if each user had one URL list.

    Lists of heavy users are cut, with as much overlap as the longest needle needs.  A LIKE
    pattern may span any number of URLs: in mode ``like`` the parts of a heavy user are
    matched one by one and what they say is put together in order.  Scope ``url`` needs
    no lists at all.
    """
    if options.get("scope", "row") == "url":
        single = visits.select(key, F.array(url).alias("dollar_url_list"))
        return product_labels(single, rules, dictionary, key=key, **options)
    rules, _ = held(rules.select("transfer_rule", "value").distinct(), HELD_RULES)
    if options.get("mode", "contains") == "like":
        overlap = longest_segment(clean_rules(rules, "like"))
        list_urls = max(list_urls, overlap)
        lists = user_url_lists(visits, key, order, url, list_urls, overlap)
        return product_labels(lists, rules, dictionary, key=key, match=match_cut_lists, list_urls=list_urls, **options)
    lists = lists_for_rules(visits, clean_rules(rules), key, order, url, list_urls)
    return product_labels(lists, rules, dictionary, key=key, **options)


def label_snapshot(
    users: DataFrame, rules: DataFrame, dictionary: DataFrame, connection: Connection | str, table: str, day: str, **options
) -> str:
    """Publish ``product_labels`` as the relational table of ``day``."""
    return write_snapshot(product_labels(users, rules, dictionary, **options), connection, table, day)


def product_tag_partition(
    source: DataFrame,
    code_map: DataFrame,
    product: str,
    table: str,
    *,
    task_id: str,
    run_date: str,
    log_path: str,
    product_label2: str | None = None,
    process_time: str | None = None,
    scope: str = "value",
    template: str | None = None,
    path: str | None = None,
    partition_key: tuple[str, ...] = ("product_type", "dt"),
) -> int:
    """Tag ``source`` by the rules of one product and replace that product's partition.

    The rows carry ``product_type`` and ``dt`` of the code map and, when given,
    ``product_label2`` and ``process_time``.  A ``template`` may reshape them: a
    query over ``{tagged}`` with ``:run_date`` bound.  ``partition_key`` names the
    columns of the result the table is partitioned by.  The table is created from
    the result if it is missing.  The run log is written last, also for a run
    without rows, which leaves the table as it was.
    """
    spark = source.sparkSession
    rules = product_rules(code_map, product)
    product_type, dt = product_partition(rules)
    extra = {"product_label2": product_label2, "process_time": process_time}
    tagged = with_tags(source, rules, scope).withColumns(
        {name: F.lit(value) for name, value in extra.items() if value is not None}
    )
    tagged = tagged.withColumn("product_type", F.lit(product_type)).withColumn("dt", F.lit(dt))
    if template:
        tagged = run_template(spark, template, args={"run_date": run_date}, tagged=tagged)
    create_like(spark, table, tagged, list(partition_key), path)
    rows = overwrite_partitions(tagged, table)
    database, _, name = table.rpartition(".")
    log_run(spark, log_path, task_id, run_date, database or spark.catalog.currentDatabase(), name, rows)
    return rows


def interest_snapshot(
    degree_facts: DataFrame, class_facts: DataFrame, connection: Connection | str, day: str, **options
) -> str:
    """Publish the interest table of ``day``."""
    return write_snapshot(interest_wide(degree_facts, class_facts, **options), connection, INTEREST_TABLE, day)
