"""Substring search by postings against a scan of all names."""

import re

import pytest
from pyspark.sql import functions as F

from basketry.functions.text import contains_ignore_case
from basketry.operators import name_index
from basketry.plans import recommend
from basketry.sources.results import write_key_ordered

NAMES = ["", "a", "ab", "abc", "ABCabc", "aaaa", "xabcabd", "Größe Ω", "GRÖSSE", "tab\tc", "a\0\0", "ab\0", "\0\0\0", "İx", "aXbc", "%_", "a%b",
         "naïve", "x😀y", "ababab" * 40]
NEEDLES = ["", "a", "A", "ab", "bc", "abc", "ABCA", "abcabc", "aa", "aaa", "aaaa", "aaaaa", "größe", "ö", "Ω", "b\t", "\0", "a\0", "a\0\0", "\0\0\0", "i",
           "İ", "%", "%_", "x😀", "😀y", "ï", "bababababa", "zz", "zzz", "zzzz"]


@pytest.fixture(scope="module")
def names(spark):
    rows = list(enumerate(NAMES)) + [(100, None), (None, "abc"), (5, "aaaa")]  # no name, no key, a repeated row
    return spark.createDataFrame(rows, "id int, name string")


def scanned(names, needle):
    return {r["id"] for r in names.filter(contains_ignore_case("name", needle)).collect()}


def test_same_rows_as_a_scan(names):
    found = name_index.find(name_index.postings(names, "id", "name"), "id", NEEDLES).collect()
    assert len(found) == len(set(found))
    for needle in NEEDLES:
        assert {r["id"] for r in found if r["needle"] == needle} == scanned(names, needle), repr(needle)


def test_no_names_and_no_needles(spark, names):
    empty = spark.createDataFrame([], "id int, name string")
    assert name_index.find(name_index.postings(empty, "id", "name"), "id", ["", "abc"]).count() == 0
    index = name_index.postings(names, "id", "name")
    assert index.columns == ["gram", "id", "place", "rest"]
    assert name_index.find(index, "id", []).count() == 0
    twice = name_index.find(index, "id", ["abc", "abc"])
    assert twice.count() == twice.distinct().count() == len(scanned(names, "abc"))


def test_a_search_reads_postings_of_its_grams_only(spark, tmp_path):
    products = spark.range(4000).select(F.col("id").alias("product_id"), F.concat_ws(" ", F.sha2(F.col("id").cast("string"), 256), F.lit("common part")).alias("name"))
    path = str(tmp_path / "index")
    write_key_ordered(name_index.postings(products, "product_id", "name"), path, ["gram", "product_id"])
    index = spark.read.parquet(path)
    found = name_index.find(index, "product_id", ["common", "7f3a"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram,com)" in plan and "EqualTo(gram,7f3)" in plan and "name" not in re.findall(r"ReadSchema: struct<([^>]*)>", plan)[0]
    assert {r["product_id"] for r in found.filter("needle = '7f3a'").collect()} == {
        r["product_id"] for r in products.filter(F.col("name").contains("7f3a")).collect()}
    assert found.filter("needle = 'common'").count() == 4000
    # A gram that every name holds fills several files, each with other products.
    at = index.filter("gram = 'com'").select(F.input_file_name().alias("file")).distinct().count()
    files = index.select(F.input_file_name().alias("file")).distinct().count()
    assert 1 <= at < files


def test_partners_found_by_index_are_those_of_a_scan(spark):
    products = spark.createDataFrame([(1, "Steel ring"), (2, "Bolt"), (3, "RINGLET"), (4, "Nut"), (5, None)], "product_id int, name string")
    best = spark.createDataFrame([(1, 2, 9), (2, 4, 8), (4, 2, 7), (2, 3, 6), (4, 5, 5), (5, 1, 4)], "source_product int, recommended_product int, co_purchase_count long")
    index = name_index.postings(products, "product_id", "name")
    scan = recommend._with_names(best, products)
    for text in ("ring", "RI", "t", "", "nothing"):
        mine, theirs = recommend.search_by_index(best, products, index, text).collect(), recommend.search_recommendations(scan, text).collect()
        assert mine == theirs, text
