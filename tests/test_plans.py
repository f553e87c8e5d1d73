"""Plans have the shape that they were written for."""

from __future__ import annotations

import re

import pytest

import sparkloom.registry as registry
from sparkloom.plans import inspect

registry.load()


def plan(spark, sf_dir, name):
    return registry.QUERIES[name](spark, sf_dir)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = plan(spark, sf_dir, "f01_equality_predicates")
    assert "EqualTo(o_orderstatus,F)" in inspect.pushed_filters(df)[0]
    df = plan(spark, sf_dir, "g04_count_distinct")
    assert inspect.columns_read(df) == [{"l_returnflag", "l_orderkey", "l_partkey"}]


def test_division_is_two_anti_joins(spark, sf_dir):
    assert len(re.findall("LeftAnti", inspect.plan_text(plan(spark, sf_dir, "j09_relational_division")))) >= 2


@pytest.mark.parametrize("name", ["j02_candidate_generation", "j03_variant_fallback"])
def test_pairs_are_not_dealt_by_word_alone(spark, sf_dir, name):
    text = inspect.plan_text(plan(spark, sf_dir, name))
    merged = re.findall(r"\) SortMergeJoin.*\nLeft keys \[\d+\]: \[(.*)\]", text)
    assert sum("_left" in keys and "_right" in keys for keys in merged) == 2


def test_hashes_are_not_broadcast_by_the_size_of_a_file(spark, sf_dir):
    text = inspect.plan_text(plan(spark, sf_dir, "v13_remediation_rules"))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 6  # in the tree, and with its details


def test_top_k_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in inspect.plan_text(plan(spark, sf_dir, "w08_order_by_limit"))


@pytest.mark.parametrize("name", ["n03_glossary_sets", "n06_sense_context", "s09_tag_harvest"])
def test_articles_are_walked_once_by_many_tasks(spark, sf_dir, name):
    text = inspect.plan_text(plan(spark, sf_dir, name))
    assert text.count("Scan parquet") == 2 and "Join" not in text  # in the tree, and with its details
    assert "RoundRobinPartitioning" in text


#: A row or three on the other side: scalars, and the phases of a window.
SCALARS = {"c09_source_identity", "c11_source_preflight", "c15_batch_verification", "c16_table_parity", "c17_manifest_consistency", "f08_time_range", "f09_expired_lease", "g18_rates", "g20_event_window_summary", "g23_ordered_fingerprint", "j16_snapshot_difference", "q06_phase_windows", "q10_window_classification", "q13_deadline_decision", "u01_insert_or_ignore", "u13_requeue_one_claim"}


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if n[0] in "cfgjquw" and n not in SCALARS))
def test_no_cross_joins(spark, sf_dir, name):
    text = inspect.plan_text(plan(spark, sf_dir, name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
