"""The plan rewrites are exact: quarter pre-filter and two-step distinct counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import counts as K
from ledgerline.plans import reports as R
from tests.helpers import AS_OF, multiset


@pytest.mark.parametrize("as_of", [AS_OF, dt.date(2001, 7, 1), dt.date(2001, 9, 15), dt.date(2001, 10, 1), None])
def test_quarter_prefilter_is_exact(fixture_tables, as_of):
    # Yesterday is in a quarter-end month, out of one, its last day, and the real current date's.
    t = fixture_tables
    for build in (lambda p: R.participant_report(t, "quarterly", as_of, prefilter=p),
                  lambda p: R.plan_report(t, "quarterly", as_of, prefilter=p),
                  lambda p: R.client_report(t, "quarterly", as_of, prefilter=p)):
        assert multiset(build(True).collect()) == multiset(build(False).collect())


def test_division_prefilter_is_exact(spark, fixture_tables):
    # Also with divisions that are blank, padded, blanks only or the sentinel itself.
    p = fixture_tables.participant
    k = F.pmod(F.xxhash64("participant_id"), F.lit(9))
    odd = (F.when(k == 0, F.lit("")).when(k == 1, F.lit("  ")).when(k == 2, F.lit("-9999")).when(k == 3, F.lit(" -9999 "))
           .when(k == 4, F.lit(None)).when(k == 5, F.concat(F.lit(" "), "div_sub_id")).otherwise(F.col("div_sub_id")))
    for t in (fixture_tables, fixture_tables.with_(participant=p.withColumn("div_sub_id", odd))):
        a = R.div_sub_report(t, AS_OF, sort=False, prefilter=True).collect()
        b = R.div_sub_report(t, AS_OF, sort=False, prefilter=False).collect()
        assert a and multiset(a) == multiset(b)


def test_sorted_div_sub_equals_unsorted_and_is_in_order(fixture_tables):
    rows = R.div_sub_report(fixture_tables, AS_OF, sort=True).collect()
    keys = [(r.plan_number, r.div_sub_id) for r in rows]
    assert keys == sorted(keys, reverse=True)
    assert multiset(rows) == multiset(R.div_sub_report(fixture_tables, AS_OF, sort=False).collect())


def test_two_step_counts_equal_count_distinct(fixture_tables):
    p = fixture_tables.participant
    for keys in (["plan_number"], ["plan_number", "client_id", "source_cycle_date"]):
        a = K.participant_counts(p, keys, "two_step").collect()
        b = K.participant_counts(p, keys, "distinct").collect()
        assert multiset(a) == multiset(b)
