"""The plans the jobs should have: few stages, pruned scans, each value decoded once."""

import pytest
from pyspark.sql import functions as F

from loadstone import parse_spec
from loadstone.operators import quality as Q
from loadstone.operators.export import export_lines
from loadstone.operators.inference import column_statistics
from loadstone.sources.tables import export_filter, export_streams

SF = "/root/testdata/sf0.001"
SPEC = "a:INT64,b:NUMERIC:12.2,c:DATE,d"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_export_is_one_stage(orders):
    assert "Exchange" not in plan(export_lines(export_streams(orders, 1)))
    # Streams beyond the splits that hold rows are dealt out before they are formatted.
    assert plan(export_lines(export_streams(orders, 8))).count("Exchange RoundRobin") == 1


def test_export_filter_reaches_the_scan(orders):
    text = plan(export_lines(export_filter(orders, "o_orderkey > 5").select("o_orderkey", "o_custkey")))
    assert "GreaterThan(o_orderkey,5)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_load_is_one_stage(text):
    for rows in (Q.typed_rows, Q.good_rows, Q.strict_rows, Q.bad_rows):
        assert "Exchange" not in plan(rows(text("1"), parse_spec(SPEC)))


def test_values_are_decoded_once(text):
    for rows in (Q.good_rows, Q.strict_rows, Q.bad_rows):
        shown = plan(rows(text("1"), parse_spec(SPEC)))
        assert shown.count("as bigint)") == 1, rows
        assert shown.count("split(value") == 1, rows


def test_unused_columns_are_not_decoded(text):
    shown = plan(Q.typed_rows(text("1"), parse_spec(SPEC)).groupBy("d").agg(F.sum("a")))
    assert "as bigint" in shown and "decimal" not in shown and "date" not in shown


def test_no_python(text, orders):
    for df in (Q.good_rows(text("1"), parse_spec(SPEC)), column_statistics(text("1"), 2), export_lines(orders)):
        assert "Python" not in plan(df)


def test_inference_combines_before_its_shuffle(text):
    shown = plan(column_statistics(text("1"), 3))
    assert shown.count("Exchange") == 1 and "partial_bit_and" in shown


def test_generated_methods_stay_below_the_compiler_limit(spark, text):
    """Twelve columns of mixed types as one stage."""
    spec = parse_spec(",".join(f"c{i}:{t}" for i, t in enumerate(["INT64", "NUMERIC:12.2", "DATE", "STRING"] * 3)))
    jvm = spark._jvm.org.apache.spark.sql.execution.debug
    getattr(jvm, "package")
    for rows in (Q.typed_rows, Q.good_rows, Q.strict_rows):
        executed = rows(text("1").repartition(2), spec)._jdf.queryExecution().executedPlan()
        stages = getattr(jvm, "package").codegenStringSeq(executed)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert max(sizes, default=0) < 8000, rows


def test_text_is_made_once_for_its_decoder(spark):
    """The text that a decoding query starts from is one column, not an expression for each use."""
    from __spark_entry__ import queries

    text = queries()["decode_numeric"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("CASE WHEN (l_linenumber") == 1
