import copy
import random
from datetime import datetime
from decimal import Decimal, localcontext

import pytest
from oracle import plan
from pyspark.sql import functions as F

from tillmark.functions.dates import fits_format
from tillmark.operators import metric_contract, quality
from tillmark.plans.catalog import METRIC_CONTRACT
from tillmark.sources import delimited, fixtures, scratch

PARCELS = {
    "dataset": {"primary_key": ["parcel"]}, "expectations": {"min_rows": 2, "max_rows": 50},
    "columns": [
        {"name": "parcel", "type": "string", "required": True, "nullable": False},
        {"name": "sent", "type": "date", "format": "%d.%m.%Y", "required": True, "nullable": False},
        {"name": "depot", "type": "string", "required": True, "nullable": False, "allowed_values": ["Kiel", "Ulm", "Jena"]},
        {"name": "boxes", "type": "integer", "required": True, "nullable": False, "min": 2, "max": 40},
        {"name": "weight", "type": "number", "required": True, "nullable": False, "min": 0.5},
    ],
}
HEADER = "parcel;sent;depot;boxes;weight"
ONE, TWO = "p7;14.03.2024;Kiel;4;31.20", "p8;15.03.2024;Jena;6;48.60"


def scanned(spark, tmp_path, *lines, header=HEADER):
    path = tmp_path / "parcels.csv"
    path.write_text("\ufeff" + "\n".join([header, *lines]) + "\n", encoding="utf-8")
    return delimited.scan_contract_csv(spark, str(path), ";", row="row")


def found(table, contract=PARCELS):
    return {(r.code, r.scope, r.row) for r in quality.issue_list(table, contract, "row").collect()}


def test_valid_file_passes(spark, tmp_path):
    table = scanned(spark, tmp_path, ONE, TWO)
    row = quality.quality_summary(table, PARCELS, "row", locator_is_data=False).first()
    assert tuple(row) == ("passed", 2, 5, 0)


@pytest.mark.parametrize("line, issue", [
    ("p7;15.03.2024;Jena;6;48.60", ("duplicate_primary_key", "parcel", 3)),
    ("p8;15.03.2024;;6;48.60", ("null_not_allowed", "depot", 3)),
    ("p8;15.03.2024;Jena;six;48.60", ("invalid_type", "boxes", 3)),
    ("p8;15.03.2024;Jena;06;48.60", ("invalid_type", "boxes", 3)),
    ("p8;31.04.2024;Jena;6;48.60", ("invalid_type", "sent", 3)),
    ("p8;15.03.2024;Jena;41;48.60", ("above_maximum", "boxes", 3)),
    ("p8;15.03.2024;Jena;1;48.60", ("below_minimum", "boxes", 3)),
    ("p8;15.03.2024;Bonn;6;48.60", ("not_allowed", "depot", 3)),
    ("p8;5.3.2024;Jena;6;4.86e1", None),
    # Numbers of any length have a type and meet their bounds.
    ("p8;15.03.2024;Jena;" + "9" * 45 + ";48.60", ("above_maximum", "boxes", 3)),
    ("p8;15.03.2024;Jena;-" + "9" * 45 + ";48.60", ("below_minimum", "boxes", 3)),
    ("p8;15.03.2024;Jena;6;0." + "4" + "9" * 40, ("below_minimum", "weight", 3)),
    ("p8;15.03.2024;Jena;6;0.5" + "0" * 40, None),
    ("p8;15.03.2024;Jena;6;1" + "0" * 60 + ".5", None),
    ("p8;15.03.2024;Jena;6;1e-30", ("below_minimum", "weight", 3)),
    ("p8;15.03.2024;Jena;6;1e300", None),
    ("p8;15.03.2024;Jena;6;48,60", ("invalid_type", "weight", 3)),
])
def test_one_defect_gives_one_issue(spark, tmp_path, line, issue):
    assert found(scanned(spark, tmp_path, ONE, line)) == ({issue} if issue else set())


def test_missing_column_and_too_few_rows(spark, tmp_path):
    table = scanned(spark, tmp_path, "p7;14.03.2024;Kiel;4", header="parcel;sent;depot;boxes")
    assert found(table) == {("missing_required_column", "weight", None), ("below_minimum_rows", "expectations.min_rows", None)}


def test_findings_name_rows_behind_line_breaks(spark, tmp_path):
    assert found(scanned(spark, tmp_path, '"p\n7";14.03.2024;Kiel;4;31.20', "", "p8;15.03.2024;Jena;x;1", ONE.replace("Kiel", "Bonn"))) == {
        ("invalid_type", "boxes", 3), ("not_allowed", "depot", 4)}


def test_unique_column_counts_raw_text_and_skips_blanks(spark, tmp_path):
    contract = copy.deepcopy(PARCELS)
    contract["columns"][4].update(unique=True, nullable=True)
    rest = ["p2;15.03.2024;Ulm;6;31.20", "p3;15.03.2024;Ulm;6;31.2", "p4;15.03.2024;Ulm;6;", "p5;15.03.2024;Ulm;6;"]
    assert found(scanned(spark, tmp_path, ONE, *rest), contract) == {("duplicate_unique_value", "weight", 3)}


def with_rule(expression, tolerance=0.01):
    contract = copy.deepcopy(PARCELS)
    for column in contract["columns"]:
        column.pop("min", None), column.pop("max", None)
    contract["row_rules"] = [{"name": "rule", "type": "formula", "target": "weight", "expression": expression, "tolerance": tolerance}]
    return contract


MISMATCH, NO_VALUE = ("formula_mismatch", "rule", 2), ("formula_evaluation_error", "rule", 2)


@pytest.mark.parametrize("expression, issue", [
    ("boxes * 7.8", None), ("boxes * 8", MISMATCH), ("boxes * (8 - 0.2)", None), ("-boxes + 35.2", None), ("124.8 / boxes", None),
    ("31.19 + 0 * boxes", None), ("31.18 + 0 * boxes", MISMATCH), ("1 / (boxes - 4)", NO_VALUE),
    # Constants are decimals: in binary 0.1 * 3 is not 0.3, and a division by zero is a finding, not a crash.
    ("31.2 + (0.1 * 3 - 0.3) * 1e30", None), ("1 / 0", NO_VALUE), ("31.2", None), ("+31.2 - 0", None), ("2 + 3 * 4 + 17.2", None), ("100 / 4 / 5 * 6.24", None),
])
def test_formula(spark, tmp_path, expression, issue):
    table = scanned(spark, tmp_path, ONE, "p8;15.03.2024;Jena;six;48.60")
    # A formula without columns judges the third row as well.
    assert {i for i in found(table, with_rule(expression)) if i[:2] != ("formula_mismatch", "rule") or i[2] == 2} - {(*NO_VALUE[:2], 3)} == {
        ("invalid_type", "boxes", 3), *([issue] if issue else [])}


@pytest.mark.parametrize("boxes, weight, expression, tolerance, issue", [
    ("1234567890123", "2469135780246", "boxes * 2", 0, None),
    ("1234567890123", "2469135780247", "boxes * 2", 0, MISMATCH),
    ("3", "0.3000001", "boxes / 10", 0.0000001, None),
    ("3", "0.3000002", "boxes / 10", 0.0000001, MISMATCH),
    ("3", "0.30000000000000000000001", "boxes / 10", 0, MISMATCH),
    ("1" + "0" * 25, "1" + "0" * 50, "boxes * boxes", 0, None),
    ("1" + "0" * 25, "1" + "0" * 24 + "1" + "0" * 25, "boxes * boxes", 0, MISMATCH),
    ("1" + "0" * 40, "1e-40", "1 / boxes", 0, None),
    ("7", "1.142857142857142857", "8 / boxes", 1e-15, None),
])
def test_formula_over_long_numbers(spark, tmp_path, boxes, weight, expression, tolerance, issue):
    table = scanned(spark, tmp_path, f"p7;14.03.2024;Kiel;{boxes};{weight}", TWO)
    assert {i for i in found(table, with_rule(expression, tolerance)) if i[2] == 2} == ({issue} if issue else set())


@pytest.mark.parametrize("expression", [
    '__import__("os")', "boxes ** 2", "boxes // 2", "abs(boxes)", "boxes.x", "boxes if 1 else 2", "(boxes)(2)", "boxes +", "lambda: 1", "", "True", "0x10",
    "1j", "'1'", "boxes @ 2", "boxes < 2", "[boxes]", "1_000", "~boxes", "(" * 300 + "1" + ")" * 300,
])
def test_unsafe_formula_is_refused(spark, tmp_path, expression):
    with pytest.raises(ValueError, match="unsupported_formula_expression"):
        quality.row_issues(scanned(spark, tmp_path, ONE), with_rule(expression), "row")


def test_formula_over_a_column_that_the_contract_lacks(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown_formula_column: pallets"):
        quality.row_issues(scanned(spark, tmp_path, ONE), with_rule("pallets * 2"), "row")


DATES = {
    "%Y-%m-%d": ["2024-02-29", "2023-02-29", "2024-2-9", "2024-13-01", "0000-01-01", "2024-02-30", "24-02-03", "2024-04-31", "1900-02-29", "2000-02-29"],
    "%d %b %Y": ["3 Mar 2024", "31 APR 2024", "30 apr 2024", "29 feb 2023", "3 Mars 2024", "3  Mar\t2024"],
    "%B %d, %y": ["June 31, 24", "june 30, 24", "February 29, 00", "February 29, 68", "February 29, 70"],
    "%Y%j": ["2024366", "2023366", "2024000", "2024001", "9999366", "20247"],
    "%I:%M %p": ["12:30 pm", "0:30 am", "13:00 pm", "1:5 AM", "11:60 am"],
    "%H:%M:%S.%f": ["23:59:59.123456", "23:59:59.1234567", "24:00:00.1", "1:2:3.4", "00:00:60.0"],
    "%a %d %b %H:%M:%S %Y": ["Mon 01 Jan 10:00:00 2024", "Xyz 01 Jan 10:00:00 2024"],
    "%c": ["Tue Mar  5 01:02:03 2024", "Tue Mar 5 01:02:03 2024"],
    "%Y-%m-%dT%H:%M:%S%z": ["2024-01-01T00:00:00+0100", "2024-01-01T00:00:00+01:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+2400", "2024-01-01T00:00:00"],
    "%d%%%m (%Y)": ["01%02 (2024)", "01%13 (2024)", "0102 (2024)"],
    "%d.%m": ["29.02", "28.02", "31.12"], "%x %X": ["02/29/24 1:02:03", "02/29/23 1:02:03"],
}


@pytest.mark.parametrize("form", sorted(DATES))
def test_dates_read_as_strptime_reads_them(spark, form):
    def reads(text):
        try:
            return bool(datetime.strptime(text, form))
        except ValueError:
            return False

    rows = spark.createDataFrame([(text,) for text in DATES[form]], "text string")
    got = {r.text: r.fits for r in rows.select("text", fits_format(F.col("text"), form).alias("fits")).collect()}
    assert got == {text: reads(text) for text in DATES[form]}


def test_unknown_directive_is_refused():
    for form in ("%Q", "%Y %Y", "%"):
        with pytest.raises(ValueError, match="unsupported_date_directive"):
            fits_format(F.lit(""), form)


def test_hot_duplicate_key_flags_every_later_row(spark):
    table = spark.range(3000).selectExpr("id AS row", "IF(id % 3 = 0, 'HOT', concat('K', id)) AS parcel")
    contract = {"dataset": {"primary_key": ["parcel"]}, "columns": [{"name": "parcel", "type": "string"}]}
    issues = quality.key_issues(table, contract, "row")
    assert issues.count() == 999 and issues.filter("row = 0").count() == 0


def test_hot_key_is_dealt_over_tasks(spark):
    """A key with a third of the rows, others that come twice: no task gets more than twice the median."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        table = spark.range(30000).selectExpr("id AS row", "IF(id % 3 = 0, 'HOT', concat('K', id % 10000)) AS parcel")
        contract = {"dataset": {"primary_key": ["parcel"]}, "columns": [{"name": "parcel", "type": "string"}]}
        issues = quality.key_issues(table, contract, "row")
        sizes = sorted(r["count"] for r in issues.groupBy(F.spark_partition_id().alias("task")).count().collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    kept = table.select("parcel").distinct().count()
    assert sum(sizes) == 30000 - kept and len(sizes) == 8
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_only_rows_of_repeated_keys_travel_with_their_texts(spark, monkeypatch):
    kept, store = {}, quality.stored

    def watched(frame, name, codec=None):
        kept[name] = store(frame, name, codec)
        return kept[name]

    monkeypatch.setattr(quality, "stored", watched)
    table = spark.createDataFrame([(i, f"K{i % 990}" if i else None) for i in range(1000)] + [(1, "K1"), (None, "K990"), (None, "K990")], "row long, parcel string")
    contract = {"dataset": {"primary_key": ["parcel"]}, "columns": [{"name": "parcel", "type": "string"}]}
    found = sorted(r.row for r in quality.key_issues(table, contract, "row").collect() if r.row is not None)
    assert found == [1, *range(991, 1000)]
    assert kept["keys"].count() == 2 * 9 + 1


def test_all_checks_read_one_stored_table(spark, monkeypatch):
    kept, store = [], quality.stored

    def watched(frame, name, codec=None):
        kept.append(name)
        return store(frame, name, codec)

    monkeypatch.setattr(quality, "stored", watched)
    table = spark.range(20).selectExpr("id AS row", "id % 19 AS parcel", "'x' AS `Parcel `", "id AS other")
    contract = {"dataset": {"primary_key": ["parcel"]}, "expectations": {"max_rows": 5}, "columns": [{"name": "parcel", "type": "integer", "max": 17}, {"name": "Parcel ", "type": "string"}]}
    issues = quality.issue_list(table, contract, "row")
    assert kept.count("checked") == 1 and not [f for f in plan(issues).splitlines() if "Range (" in f]
    assert sorted((r.code, r.row) for r in issues.collect()) == [("above_maximum", 18), ("above_maximum_rows", None), ("duplicate_primary_key", 19)]
    (summary,) = quality.quality_summary(table, contract, "row").collect()
    assert (summary.row_count, summary.column_count, summary.issue_count) == (20, 4, 3) and kept.count("checked") == 2


def test_shuffle_files_of_a_stored_table_go(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with scratch.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
    assert scratch.stored(spark.range(100).repartition(3), "rows").count() == 100


METRICS = [
    {"id": "parcels", "aggregation": "distinct_count", "column": "parcel", "expected": 2, "tolerance": 0},
    {"id": "load", "aggregation": "sum", "column": "weight", "expected": 79.79, "tolerance": 0.01},
    {"id": "boxes", "aggregation": "sum", "column": "boxes", "expected": 11, "tolerance": 0.5},
    {"id": "mean_load", "aggregation": "ratio", "numerator_metric": "load", "denominator_metric": "parcels", "expected": 39.9, "tolerance": 0},
    {"id": "mean_boxes", "aggregation": "average", "column": "boxes", "expected": 5, "tolerance": 0},
    {"id": "chained", "aggregation": "ratio", "numerator_metric": "mean_load", "denominator_metric": "boxes", "expected": 3.99, "tolerance": 0},
]


def test_metric_contract(spark, tmp_path):
    table = scanned(spark, tmp_path, ONE, TWO)
    checked = metric_contract.snapshot_check(metric_contract.contract_metrics(table, METRICS), METRICS).collect()
    assert {r.metric_id: (r.actual, r.exact, r.status) for r in checked} == {
        "parcels": (2.0, "2", "passed"), "load": (79.8, "79.8", "passed"), "boxes": (10.0, "10", "failed"),
        "mean_load": (39.9, "39.9", "passed"), "mean_boxes": (5.0, "5", "passed"), "chained": (3.9899999999999998, "3.99", "passed"),
    }
    assert {r.issue for r in checked if r.metric_id == "boxes"} == {"metric_mismatch"}


def test_metric_contract_errors(spark, tmp_path):
    metrics = [
        {"id": "bad", "aggregation": "sum", "column": "depot"},
        {"id": "none", "aggregation": "average", "column": "weight"},
        {"id": "zero", "aggregation": "sum", "column": "boxes"},
        {"id": "by_zero", "aggregation": "ratio", "numerator_metric": "zero", "denominator_metric": "zero"},
        {"id": "after", "aggregation": "ratio", "numerator_metric": "by_zero", "denominator_metric": "zero"},
        {"id": "loop_a", "aggregation": "ratio", "numerator_metric": "loop_b", "denominator_metric": "zero"},
        {"id": "loop_b", "aggregation": "ratio", "numerator_metric": "loop_a", "denominator_metric": "zero"},
    ]
    rows = metric_contract.contract_metrics(scanned(spark, tmp_path, "p1;14.03.2024;Ulm;0;"), metrics).collect()
    assert {r.metric_id: r.issue for r in rows} == {
        "bad": "invalid_metric_input", "none": "empty_metric_input", "zero": None, "by_zero": "zero_metric_denominator",
        "after": "unresolved_metric_dependency", "loop_a": "unresolved_metric_dependency", "loop_b": "unresolved_metric_dependency",
    }
    with pytest.raises(ValueError, match="unsupported_aggregation"):
        metric_contract.contract_metrics(rows and spark.range(1), [{"id": "m", "aggregation": "median", "column": "id"}])


def test_sums_are_exact_at_any_length(spark):
    rng = random.Random(8)
    texts = [rng.choice(["", "-", "+"]) + "".join(rng.choice("0123456789") for _ in range(rng.choice([1, 5, 17, 60]))) + rng.choice(["", ".", ".5", ".0000000000000000000000000007"])
             for _ in range(200)] + ["1e40", "-1e40", "2.5E-33", "0", "-0.0", None, "  "]
    texts += ["9" * 30] * 50
    table = spark.createDataFrame([(t, t) for t in texts], "a string, b string").repartition(5)
    metrics = [{"id": "a", "aggregation": "sum", "column": "a"}, {"id": "mean", "aggregation": "average", "column": "a"},
               {"id": "kinds", "aggregation": "distinct_count", "column": "b"}]
    got = {r.metric_id: r for r in metric_contract.contract_metrics(table, metrics).collect()}
    filled = [t for t in texts if t and t.strip()]
    with localcontext() as context:
        context.prec = 200
        total = sum(Decimal(t) for t in filled)
        assert Decimal(got["a"].exact) == total and got["a"].actual == float(total)
        assert abs(Decimal(got["mean"].exact) / (total / len(filled)) - 1) < Decimal("1e-27")
        assert got["kinds"].exact == str(len(set(filled)))
        # A difference in the last of some hundred digits counts.
        for shift, status in ((Decimal(0), "passed"), (Decimal("1e-33"), "failed")):
            one = [{**metrics[0], "expected": str(total + shift), "tolerance": 0}]
            checked = metric_contract.snapshot_check(metric_contract.contract_metrics(table, one), one).first()
            assert checked.status == status


@pytest.mark.parametrize("texts, total", [(["5", "-7"], "-2"), (["-999999", "-1"], "-1000000"), (["0.000001", "-0.000001"], "0"), ([], "0"), (["1e4999"], None), (["1e5001"], None)])
def test_small_sums(spark, texts, total):
    table = spark.createDataFrame([(t,) for t in texts], "a string")
    row = metric_contract.contract_metrics(table, [{"id": "a", "aggregation": "sum", "column": "a"}]).first()
    if total is not None:
        assert row.exact == total
    else:
        assert (row.issue == "invalid_metric_input") == (texts == ["1e5001"])


def test_metrics_plan_copies_no_rows_per_count(spark, sf_dir):
    text = plan(metric_contract.contract_metrics(fixtures.contract_text(spark, sf_dir), METRIC_CONTRACT))
    assert "Expand [" not in text and text.count("FileScan parquet") == plan(fixtures.contract_text(spark, sf_dir)).count("FileScan parquet")


def test_no_filter_on_cells_works_the_checks_out_again(spark):
    contract = {"dataset": {"primary_key": ["id"]}, "columns": [
        {"name": "id", "type": "string"}, {"name": "n", "type": "number", "min": 1, "max": 5}]}
    found = quality.row_issues(spark.createDataFrame([("a", "7"), ("b", "0"), ("c", "3"), ("d", "x")], "id string, n string"), contract, "id")
    filters = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert all("rlike" not in line.lower() for line in filters)
    assert sorted((r.code, r.row) for r in found.collect()) == [("above_maximum", "a"), ("below_minimum", "b"), ("invalid_type", "d")]
