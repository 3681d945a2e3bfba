"""Contract-driven checks; every finding is one row of (code, scope, row, message).

Cell checks unpivot a row into its cells and run one small expression over them, however
many columns the contract has; a wide expression per row would outgrow what the JVM
compiles. Key checks group before they join, and deal keys with very many rows over tasks.
"""

from __future__ import annotations

import ast
import operator
import re
from collections.abc import Mapping, Sequence
from decimal import Decimal, localcontext
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import exact
from tillmark.functions.dates import fits_format
from tillmark.functions.text import BOOLEAN_WORDS, stripped
from tillmark.sources.scratch import stored

# What a report says about each finding.
MESSAGES = {
    "missing_required_column": "A required column is not in the header.",
    "below_minimum_rows": "Fewer rows than the contract asks for.",
    "above_maximum_rows": "More rows than the contract allows.",
    "duplicate_primary_key": "The primary key occurred in an earlier row.",
    "duplicate_unique_value": "The unique value occurred in an earlier row.",
    "null_not_allowed": "The value is blank.",
    "invalid_type": "The text does not match the column type.",
    "not_allowed": "The value is not one of the allowed values.",
    "below_minimum": "The value lies below the minimum.",
    "above_maximum": "The value lies above the maximum.",
    "formula_mismatch": "The target differs from the formula by more than the tolerance.",
    "formula_evaluation_error": "The formula has no value for this row.",
}

DEFAULT_FORMATS = {"date": "%Y-%m-%d", "datetime": "%Y-%m-%dT%H:%M:%S"}


def _fits(text: Column, column: Mapping) -> Column:
    """Whether stripped text has the column's type; numbers may have any length."""
    kind = column["type"]
    if kind == "string":
        return text.isNotNull()
    if kind == "integer":
        return text.rlike(r"^(0|-?[1-9][0-9]*)$")
    if kind == "number":
        return text.rlike(exact.NUMBER_TEXT)
    if kind == "boolean":
        return F.lower(text).isin(*BOOLEAN_WORDS)
    if kind in DEFAULT_FORMATS:
        return fits_format(text, column.get("format", DEFAULT_FORMATS[kind]))
    raise ValueError(f"unsupported_type: {kind}")


def _staged(table: DataFrame, columns: Mapping[str, Mapping], names: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    """Columns used together in a key or formula: stripped once, then tested once."""
    texts = table.select(*keep, *[stripped(F.col(f"`{name}`")).alias(f"{name}|text") for name in names])
    return texts.withColumns({
        f"{name}|usable": F.coalesce((_part(name, "text") != "") & _fits(_part(name, "text"), columns[name]), F.lit(False))
        for name in names
    })


def _part(name: str, part: str) -> Column:
    return F.col(f"`{name}|{part}`")


Finding = tuple[str, str, Column]


def _needed(column: Mapping, codes: Sequence[str]) -> bool:
    """Whether any of the checks applies to the column at all."""
    applies = {
        "null_not_allowed": not column.get("nullable", True), "invalid_type": column["type"] != "string",
        "not_allowed": column.get("allowed_values") is not None,
        "below_minimum": "min" in column, "above_maximum": "max" in column,
    }
    return any(applies.get(code, False) for code in codes)


def _by_scope(columns: Sequence[Mapping], value) -> Column:
    """CASE over the cell's column; ``value`` gives each column its branch or None.

    Columns with the same rule share a branch, so the expression grows with the number of
    different rules only.
    """
    groups: dict[str, tuple[Column, list[str]]] = {}
    for column in columns:
        branch = value(column)
        if branch is not None:
            groups.setdefault(str(branch), (branch, []))[1].append(column["name"])
    case = None
    for branch, names in groups.values():
        test = F.col("scope").isin(*names)
        case = F.when(test, branch) if case is None else case.when(test, branch)
    return F.lit(None) if case is None else case


def _bounded(columns: Sequence[Mapping]) -> list[str]:
    return [column["name"] for column in columns if {"min", "max"} & set(column)]


def _cell_findings(columns: Sequence[Mapping]) -> dict[str, Column]:
    """The test of each code over a cell's raw, text, usable and, where it is bounded, number."""
    raw, number, usable = F.col("raw"), F.col("number"), F.col("usable")
    filled = F.coalesce(F.col("text"), F.lit("")) != ""
    low = exact.once(number, lambda x: _by_scope(columns, lambda c: exact.below(x, exact.literal(c["min"])) if "min" in c else None).cast("boolean"))
    high = exact.once(number, lambda x: _by_scope(columns, lambda c: exact.below(exact.literal(c["max"]), x) if "max" in c else None).cast("boolean"))
    allowed = _by_scope(columns, lambda c: raw.isin(*[str(v) for v in c["allowed_values"]])
                        if c.get("allowed_values") is not None else None)
    required = [column["name"] for column in columns if not column.get("nullable", True)]
    return {
        "null_not_allowed": F.col("scope").isin(*required) & ~filled,
        "invalid_type": filled & ~usable,
        "not_allowed": usable & ~allowed.cast("boolean"),
        "below_minimum": usable & low,
        "above_maximum": usable & high,
    }


# ---- formulas -------------------------------------------------------------------

def _parsed(expression: str) -> ast.expr:
    """The syntax tree of a formula: names, plain numbers, + - * / and parentheses only."""
    refused = ValueError(f"unsupported_formula_expression: {expression}")
    try:
        tree = ast.parse(expression.strip(), mode="eval").body
    except (SyntaxError, RecursionError, MemoryError) as error:
        raise refused from error
    for node in ast.walk(tree):
        if isinstance(node, ast.Constant):
            text = ast.get_source_segment(expression.strip(), node) or ""
            if not re.fullmatch(r"(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d{1,4})?", text, re.ASCII):
                raise refused
            node.kind = text
        elif isinstance(node, ast.Name):
            if not node.id.isascii():
                raise refused
        elif not isinstance(node, (ast.BinOp, ast.UnaryOp, ast.Add, ast.Sub, ast.Mult, ast.Div, ast.UAdd, ast.USub, ast.Load)):
            raise refused
    return tree


def formula_names(expression: str) -> set[str]:
    """The columns of a formula."""
    return {node.id for node in ast.walk(_parsed(expression)) if isinstance(node, ast.Name)}


def _constant(node: ast.expr) -> Decimal | None:
    """The value of a formula without columns, None where a divisor is zero."""
    if isinstance(node, ast.Constant):
        return Decimal(node.kind)
    if isinstance(node, ast.UnaryOp):
        value = _constant(node.operand)
        return -value if value is not None and isinstance(node.op, ast.USub) else value
    left, right = _constant(node.left), _constant(node.right)
    if left is None or right is None or (isinstance(node.op, ast.Div) and not right):
        return None
    steps = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}
    with localcontext() as context:
        context.prec = 2 * exact.MOST
        return steps[type(node.op)](left, right)


def _formula_value(work: exact.Work, node: ast.expr, operands: Mapping[str, exact.Operand]) -> exact.Operand:
    """The value of a formula, step by step; none where a divisor is zero."""
    if not any(isinstance(part, ast.Name) for part in ast.walk(node)):
        # Spark would unfold constant steps into one another before it folds them.
        return work.constant(_constant(node))
    if isinstance(node, ast.Name):
        return operands[node.id]
    if isinstance(node, ast.UnaryOp):
        value = _formula_value(work, node.operand, operands)
        return work.negative(value) if isinstance(node.op, ast.USub) else value
    left, right = _formula_value(work, node.left, operands), _formula_value(work, node.right, operands)
    steps = {ast.Add: work.plus, ast.Sub: work.minus, ast.Mult: work.times, ast.Div: work.over}
    return steps[type(node.op)](left, right)


CELL_CODES = ("null_not_allowed", "invalid_type", "not_allowed", "below_minimum", "above_maximum")
RULE_CODES = ("formula_mismatch", "formula_evaluation_error")


def row_issues(table: DataFrame, contract: Mapping, row: str, codes: Sequence[str] | None = None) -> DataFrame:
    """Blank, type, allowed-value, range and formula findings; ``row`` names the row locator.

    ``codes`` keeps only some checks, and only the columns those need are looked at. Formula
    results ride along as one more cell per rule, so the table is read once.
    """
    wanted = [code for code in (*CELL_CODES, *RULE_CODES) if codes is None or code in codes]
    columns = {column["name"]: column for column in contract["columns"]}
    present = set(table.columns)
    checked = [column for name, column in columns.items() if name in present and _needed(column, wanted)]
    cells = {column["name"]: F.col(f"`{column['name']}`").cast("string") for column in checked}
    source = table.withColumn("|row", F.col(row))

    rules: dict[str, Column] = {}
    if set(RULE_CODES) & set(wanted):
        source, rules = _with_rules(source, contract, columns, row, wanted, cells)
        cells = {name: F.col(f"`{name}`") for name in cells}
    wide = source.select(
        F.col("|row").alias("row"), *[value.alias(name) for name, value in cells.items()],
        *[value.alias(f"rule|{name}") for name, value in rules.items()],
    )
    if not cells and not rules:
        wide = wide.withColumn("rule|", F.lit(None).cast("string"))
    long = wide.unpivot(["row"], [name for name in wide.columns if name != "row"], "scope", "raw")

    is_rule = F.col("scope").startswith("rule|")
    typed = long.withColumn("text", stripped(F.col("raw"))).withColumn(
        "usable", ~is_rule & F.coalesce((F.col("text") != "") & exact.once(F.col("text"), lambda text: _by_scope(
            checked, lambda column: _fits(text, column)).cast("boolean")), F.lit(False)),
    )
    # Reading a number digit by digit is slow, so only cells of bounded columns are read.
    read = F.col("usable") & F.col("scope").isin(*_bounded(checked)) & F.lit(bool({"below_minimum", "above_maximum"} & set(wanted)))
    typed = typed.withColumn("number", F.when(read, exact.number(F.col("text"))))
    tests = {code: test for code, test in _cell_findings(checked).items() if code in wanted}
    names = F.array(*[F.lit(code) for code in (*CELL_CODES, *RULE_CODES)])
    number = {code: place for place, code in enumerate((*CELL_CODES, *RULE_CODES), 1)}
    found = F.array(
        *[F.when(~is_rule & test, number[code]).otherwise(0) for code, test in tests.items()],
        F.when(is_rule, F.coalesce(F.array_position(names, F.col("raw")).cast("int"), F.lit(0))).otherwise(0),
    )
    # A plain explode brings a filter on the size of its array along, which Spark takes apart and moves below all stages.
    numbered = typed.select("row", "scope", F.array_remove(found, 0).alias("numbers")).select(
        "row", "scope", F.explode_outer("numbers").alias("number")
    ).where("number IS NOT NULL")
    return _labelled(numbered.select(
        F.element_at(names, F.col("number")).alias("code"),
        F.regexp_replace("scope", "^rule[|]", "").alias("scope"), "row",
    ))


def _with_rules(
    table: DataFrame, contract: Mapping, columns: Mapping[str, Mapping], row: str, wanted: Sequence[str], cells: Mapping[str, Column],
) -> tuple[DataFrame, dict[str, Column]]:
    """The table's cells with one column per formula rule: the code of its finding, or NULL.

    A rule with a column that the table lacks is not checked; one that names a column that the
    contract lacks is refused.
    """
    rules = contract.get("row_rules", [])
    trees = [_parsed(rule["expression"]) for rule in rules]
    for rule in rules:
        for name in sorted(formula_names(rule["expression"]) | {rule["target"]}):
            if name not in columns:
                raise ValueError(f"unknown_formula_column: {name}")
    named = [formula_names(rule["expression"]) | {rule["target"]} for rule in rules]
    complete = [(rule, tree, names) for rule, tree, names in zip(rules, trees, named) if names <= set(table.columns)]
    used = sorted({name for _, _, names in complete for name in names})
    work = exact.Work(_staged(table, columns, used, [F.col(row).alias("|row"), *[v.alias(n) for n, v in cells.items()]]))
    operands = {name: work.read(F.when(_part(name, "usable"), _part(name, "text"))) for name in used}
    codes: dict[str, Column] = {}
    for rule, tree, names in complete:
        gap = work.size(work.minus(operands[rule["target"]], _formula_value(work, tree, operands)))
        usable = reduce(lambda a, b: a & b, [_part(name, "usable") for name in sorted(names)])
        code = F.when(usable & gap.isNull(), "formula_evaluation_error").when(
            usable & exact.below(exact.literal(rule.get("tolerance", 0)), gap), "formula_mismatch"
        )
        (codes[rule["name"]],) = work.keep(F.when(code.isin(*[name for name in RULE_CODES if name in wanted]), code))
    return work.table, codes


def _labelled(findings: DataFrame) -> DataFrame:
    messages = F.create_map(*[F.lit(part) for item in MESSAGES.items() for part in item])
    return findings.withColumn("message", messages[F.col("code")])


def key_issues(table: DataFrame, contract: Mapping, row: str, codes: Sequence[str] | None = None) -> DataFrame:
    """Second and later occurrences of the primary key and of unique values.

    All key kinds share one grouping. Hashes of keys are counted first, and only rows whose hash
    comes again go on with their texts; the table is read twice for that. Equal rows are counted,
    so of rows with an equal locator all but one of the first are found too. The first row of keys that
    occur more than once then meets the counted rows, of which a locator has one.

    The counted rows are stored. A key with more than one part in HEAVY of all of them is dealt
    over several tasks, and there are HEAVY such keys at most; all others meet by a plain join.
    """
    columns = {column["name"]: column for column in contract["columns"]}
    key_parts = contract["dataset"]["primary_key"]
    present = set(table.columns)

    kinds: list[tuple[str, str, Column, Column]] = []
    if set(key_parts) <= present:
        texts = [F.coalesce(_part(part, "text"), F.lit("")) for part in key_parts]
        complete = reduce(lambda a, b: a & b, [text != "" for text in texts])
        kinds.append(("duplicate_primary_key", ",".join(key_parts), complete, F.array(*texts)))
    for name, column in columns.items():
        if column.get("unique", False) and name in present:
            kinds.append(("duplicate_unique_value", name, _part(name, "usable"), F.array(F.col(f"`{name}|raw`"))))
    if codes is not None:
        kinds = [kind for kind in kinds if kind[0] in codes]
    if not kinds:
        kinds = [("", "", F.lit(False), F.array(F.lit("")))]
    unique = [name for name, column in columns.items() if column.get("unique", False) and name in present]
    used = sorted({*(part for part in key_parts if part in present), *unique})
    staged = _staged(table, columns, used, [
        F.col(row).alias("row"), *[F.col(f"`{name}`").cast("string").alias(f"{name}|raw") for name in unique],
    ])
    keyed = staged.select("row", F.inline(F.array(*[
        F.struct(F.lit(code).alias("code"), F.lit(scope).alias("scope"), F.when(usable, key).alias("key"))
        for code, scope, usable, key in kinds
    ]))).filter(F.col("key").isNotNull())
    by_key = ["code", "scope", "key"]
    again = _hashed_again(keyed, by_key)
    return _labelled(_later_rows(again.groupBy(*by_key, "row").agg(F.count("*").alias("copies")), by_key))


#: A key is dealt over tasks from one part in so many of all rows on.
HEAVY = 1024


def _hashed_again(keyed: DataFrame, by_key: list[str]) -> DataFrame:
    """The rows whose key has a hash that comes more than once: all repeated keys, and few others by chance.

    Hashes with more than one part in HEAVY of these rows are dealt over several tasks.
    """
    hashed = keyed.withColumn("hash", F.xxhash64(*by_key))
    repeated = stored(hashed.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-hashes")
    share = max(1, (repeated.agg(F.sum("n")).first()[0] or 0) // HEAVY)
    repeated = repeated.select("hash", F.ceil(F.col("n") / share).cast("int").alias("parts"))
    # HEAVY hashes at most, since each has more than one in HEAVY of all these rows.
    heavy = F.broadcast(repeated.filter("parts > 1"))
    salt = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row"), "parts").cast("int")).otherwise(0)
    salted = hashed.join(heavy, "hash", "left").withColumn("salt", salt)
    wanted = repeated.select("hash", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    return salted.join(wanted, ["hash", "salt"], "left_semi").select(*by_key, "row")


def _later_rows(counted: DataFrame, by_key: list[str]) -> DataFrame:
    """(code, scope, row) of all but the first row of each key, from rows (code, scope, key, row, copies)."""
    counted = stored(counted, "keys")
    repeated = counted.groupBy(*by_key).agg(F.min("row").alias("first_row"), F.sum("copies").alias("total"), F.count("*").alias("rows"))
    repeated = stored(repeated.filter("total > 1").select(*by_key, "first_row", "rows"), "repeated-keys")
    share = max(1, counted.count() // HEAVY)
    repeated = repeated.withColumn("parts", F.ceil(F.col("rows") / share).cast("int"))
    # HEAVY rows at most, since each has more than one in HEAVY of all rows.
    heavy = F.broadcast(repeated.filter("parts > 1").select(*by_key, "parts"))
    salted = counted.join(heavy, by_key, "left").withColumn("salt", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row"), "parts").cast("int")).otherwise(0))
    firsts = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = salted.join(firsts.select(*by_key, "salt", "first_row"), [*by_key, "salt"])
    extra = F.col("copies") - F.when(F.col("row") == F.col("first_row"), 1).otherwise(0)
    later = met.withColumn("n", extra.cast("int")).filter("n > 0")
    return later.select("code", "scope", "row", F.explode(F.array_repeat(F.lit(1), F.col("n")))).select("code", "scope", "row")


def table_issues(table: DataFrame, contract: Mapping, row: str) -> DataFrame:
    """Missing required columns and row-count bounds; these have no row."""
    expectations = contract.get("expectations", {})
    count = F.col("row_count")
    findings: list[Finding] = [
        ("missing_required_column", column["name"], F.lit(True)) for column in contract["columns"]
        if column.get("required", False) and column["name"] not in table.columns
    ]
    if expectations.get("min_rows") is not None:
        findings.append(("below_minimum_rows", "expectations.min_rows", count < expectations["min_rows"]))
    if expectations.get("max_rows") is not None:
        findings.append(("above_maximum_rows", "expectations.max_rows", count > expectations["max_rows"]))
    candidates = F.array(*[
        F.struct(F.lit(code).alias("code"), F.lit(scope).alias("scope"), test.alias("found"))
        for code, scope, test in findings or [("", "", F.lit(False))]
    ])
    nowhere = F.lit(None).cast(table.schema[row].dataType)
    counted = table.agg(F.count("*").alias("row_count")).select(F.inline(candidates)).filter("found")
    return _labelled(counted.select("code", "scope", nowhere.alias("row")))


def _checked(table: DataFrame, contract: Mapping, row: str) -> DataFrame:
    """The locator and the contract's columns as text, stored once for all checks, which read them several times."""
    names = [row, *(c["name"] for c in contract["columns"] if c["name"] in table.columns and c["name"] != row)]
    cells = [F.col(f"`{name}`") if name == row else F.col(f"`{name}`").cast("string") for name in names]
    # Headers may hold what a file of columns takes for one name twice.
    kept = stored(table.select(*[cell.alias(f"c{place}") for place, cell in enumerate(cells)]), "checked", codec="zstd")
    return kept.toDF(*names)


def issue_list(table: DataFrame, contract: Mapping, row: str) -> DataFrame:
    """Every finding of every check."""
    return _all_issues(_checked(table, contract, row), contract, row)


def _all_issues(table: DataFrame, contract: Mapping, row: str) -> DataFrame:
    return (
        row_issues(table, contract, row)
        .unionByName(key_issues(table, contract, row))
        .unionByName(table_issues(table, contract, row))
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("code", "scope").agg(F.count("*").alias("issue_count"))


def quality_summary(table: DataFrame, contract: Mapping, row: str, locator_is_data: bool = True) -> DataFrame:
    """Status, size of the table and number of findings; passed means no finding at all."""
    checked = _checked(table, contract, row)
    issues = _all_issues(checked, contract, row).agg(F.count("*").alias("issue_count"))
    rows = checked.agg(F.count("*").alias("row_count"))
    both = issues.unionByName(rows, allowMissingColumns=True).agg(
        F.max("row_count").alias("row_count"), F.max("issue_count").alias("issue_count")
    )
    column_count = len(table.columns) - (0 if locator_is_data else 1)
    return both.select(
        F.when(F.col("issue_count") == 0, "passed").otherwise("failed").alias("status"),
        "row_count", F.lit(column_count).cast("bigint").alias("column_count"), "issue_count",
    )
