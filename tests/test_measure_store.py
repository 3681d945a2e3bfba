"""The stored grain against the measures of the lines."""

import re

import pytest
from pyspark.sql import functions as F

from tillmark.operators import measures as M
from tillmark.plans import measure_store as S
from tillmark.sources import fixtures


def rows(frame):
    return sorted((tuple(sorted(r.asDict().items())) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def fact(spark, sf_dir):
    lines = fixtures.sales_line(spark, sf_dir, mixed_signs=True)
    # Numbers that lie in several months and countries, other spellings, blanks and nulls.
    bent = lines.withColumns({
        "InvoiceNo": F.expr("CASE WHEN l % 11 = 0 THEN 'SHARED' WHEN l % 13 = 0 THEN concat(' ', InvoiceNo) WHEN l % 17 = 0 THEN '' WHEN l % 19 = 0 THEN NULL ELSE InvoiceNo END".replace("l %", "length(Description) * Quantity %")),
        "Country": F.when(F.col("Country") != "NATION_4", F.col("Country")),
        "CustomerID": F.when(F.col("Quantity") == 7, "  ").otherwise(F.col("CustomerID")),
    })
    kept = bent.persist()
    yield kept
    kept.unpersist()


def test_slices_equal_the_measures_of_the_lines(spark, fact, tmp_path):
    store = S.refresh_store(fact, str(tmp_path / "store"))
    monthly = fact.withColumn("YearMonth", F.date_format("InvoiceDate", "yyyy-MM"))
    for held in (store, store.in_memory(4)):
        assert rows(S.store_measures(held)) == rows(M.measures_by(fact))
        assert rows(S.store_measures(held, ["Country"])) == rows(M.measures_by(fact, ["Country"]))
        assert rows(S.store_measures(held, ["Country", "YearMonth"])) == rows(M.measures_by(monthly, ["Country", "YearMonth"]))
        assert rows(S.store_country(held, "NATION_2")) == rows(M.measures_for_country(fact, "NATION_2"))
        for month in ("1996-11", "2040-01"):
            assert rows(S.store_month(held, month)) == rows(M.measures_for_month(fact, month))
        some = monthly.filter("YearMonth IN ('1996-11', '1997-02') AND Country IN ('NATION_2', 'NATION_7')")
        assert rows(S.store_measures(held, [], ["NATION_2", "NATION_7"], ["1996-11", "1997-02"])) == rows(M.measures_by(some))
        assert rows(S.store_measures(held, months=["2040-01"])) == rows(M.measures_by(fact.limit(0)))
    held.release()


def test_refresh_of_months_leaves_the_others(spark, fact, tmp_path):
    path = str(tmp_path / "store")
    S.refresh_store(fact, path)
    month = F.date_format("InvoiceDate", "yyyy-MM")
    changed = fact.filter((month != "1996-12") & ~((month == "1996-11") & (F.col("Quantity") > 10)))
    store = S.refresh_store(changed, path, ["1996-11", "1996-12"])
    assert rows(store.members) == rows(S.build_store(changed).members) and rows(store.cells) == rows(S.build_store(changed).cells)
    # Changes outside the named months are not taken in.
    S.refresh_store(fact.limit(0), path, ["1996-11"])
    left = S.open_store(spark, path)
    assert rows(left.cells) == rows(S.build_store(changed.filter(month != "1996-11")).cells)


def test_empty_fact(spark, fact, tmp_path):
    store = S.refresh_store(fact.limit(0), str(tmp_path / "store"))
    assert rows(S.store_measures(store)) == rows(M.measures_by(fact.limit(0)))
    assert rows(S.store_measures(store, ["Country"])) == []


def test_counts_in_memory_need_no_shuffle_of_members(spark, fact, tmp_path):
    from oracle import plan

    held = S.build_store(fact).in_memory(4)
    text = plan(S.store_measures(held))
    # The only exchange by member is the one that dealt them before they were held.
    assert not re.search(r"hashpartitioning\(is_customer[^)]*\), ENSURE", text) and "REPARTITION_BY_NUM" in text
    held.release()
