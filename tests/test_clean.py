from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marginalia.functions import columns
from marginalia.operators import clean, star
from marginalia.sources import files

HEADER = ",".join(files.RAW_HEADERS.values())


def raw_row(row_id, order="O1", product="P1", order_date="1/3/2014", ship_date="1/7/2014",
            name="Ann", sales="100.5", quantity="2", discount="0.2", profit="10"):
    return (
        f"{row_id},{order},{order_date},{ship_date},First Class,C1,{name},Consumer,Austin,Texas,"
        f'73301,South,{product},Furniture,Chairs,"Chair, ""oak""",{sales},{quantity},{discount},{profit}'
    )


@pytest.fixture
def write(tmp_path):
    def write(name, rows, encoding="utf-8"):
        path = tmp_path / "in" / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(("\n".join([HEADER, *rows]) + "\n").encode(encoding))
        return str(path.parent)

    return write


def test_dirty_values_take_their_defaults(spark, write):
    folder = write("a.csv", [
        raw_row(1),
        raw_row(2, order="O2", order_date="not a date", sales="N/A", quantity="null", discount="1.7", profit="x"),
        raw_row(3, order="O3", quantity="-4"),
        raw_row(4, product="P1", sales="999"),
        raw_row(5, order="O5", sales="0", profit="-3", order_date="2014-03-08"),
    ])
    rows = {r.row_id: r for r in clean.clean(files.read_csv(spark, folder)).collect()}
    assert set(rows) == {"1", "2", "5"}
    rows = {int(key): row for key, row in rows.items()}
    assert rows[1].order_date == dt.date(2014, 1, 3) and rows[1].ship_days == 4
    assert rows[1].product_name == 'Chair, "oak"'
    assert (rows[1].order_year, rows[1].order_month, rows[1].order_quarter) == (2014, 1, 1)
    assert rows[1].order_dayofweek == 4
    assert rows[1].profit_margin == pytest.approx(10 / 100.5)
    assert rows[2].order_date is None and rows[2].ship_days is None
    assert (rows[2].sales, rows[2].quantity, rows[2].profit) == (0, 1, 0)
    assert rows[2].discount == 1 and rows[2].profit_margin == 0
    assert rows[5].profit_margin == 0 and rows[5].is_profitable == 0
    assert rows[5].profit_per_unit == -1.5 and rows[5].order_dayofweek == 5


def test_cleaning_loses_no_digits(spark, write):
    folder = write("a.csv", [
        raw_row(1, quantity="0.5", sales="1e15", discount="0.3001", profit="0.00004", order_date="2016-11-08 00:00:00"),
        raw_row(2, order="O2", quantity="3000000000", discount="0.305", order_date="2016-11-08T10:20:30"),
        raw_row(3, order="O3", quantity="2.7", discount="0.0005", order_date="11/8/2016 9:05"),
    ])
    rows = {r.row_id: r for r in clean.clean(files.read_csv(spark, folder)).collect()}
    assert set(rows) == {"1", "2", "3"}
    assert [float(rows[key].quantity) for key in "123"] == [0.5, 3e9, 2.7]
    assert [float(rows[key].discount) for key in "123"] == [0.3001, 0.305, 0.0005]
    assert rows["1"].sales == 10**15 and float(rows["1"].profit) == 0.00004 and rows["1"].is_profitable == 1
    assert {rows[key].order_date for key in "123"} == {dt.date(2016, 11, 8)}


def test_numbers_that_do_not_fit_are_errors(spark, write):
    folder = write("a.csv", [raw_row(1, sales="1e40")])
    with pytest.raises(Exception, match="does not fit"):
        clean.clean(files.read_csv(spark, folder)).collect()


def test_columns_may_be_more_or_fewer(spark, write):
    folder = write("a.csv", [raw_row(1), raw_row(10, sales="7"), raw_row(9, sales="8"), raw_row(11, order="O2")])
    raw = files.read_csv(spark, folder).withColumn("Country", F.lit("Austria"))
    rows = clean.clean(raw.filter("`Row ID` > 1").drop("Ship Date")).orderBy("row_id").collect()
    assert [(r.row_id, float(r.sales), r.country, r.ship_date) for r in rows] == [
        ("11", 100.5, "Austria", None), ("9", 8.0, "Austria", None),
    ]
    rows = clean.clean(raw.drop("Row ID")).collect()
    assert sorted(r.row_id for r in rows) == ["O1-P1", "O2-P1"]


def test_each_file_gets_its_encoding(spark, write):
    write("a.csv", [raw_row(1, name="José")], "utf-8")
    folder = write("b.csv", [raw_row(2, order="O2", name="José")], "latin-1")
    assert files.files_not_utf8(spark, folder).count() == 1
    names = [r[0] for r in files.read_csv(spark, folder).select("Customer Name").collect()]
    assert names == ["José", "José"]


def test_rules_count_violations(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, -1, 2D, 0, NULL), (2, 1, 0.5D, 3, DATE'2020-01-01')"
        " AS t(row_id, sales, discount, quantity, order_date)"
    )
    found = {r.rule: r.violations for r in clean.validate(df, clean.CLEAN_RULES).collect()}
    assert found == {
        "sales_not_negative": 1,
        "discount_in_range": 1,
        "quantity_positive": 1,
        "order_date_present": 1,
    }


def test_key_checks(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "id int, k string")
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    assert clean.check_unique(fact, ["id"], "u").first().violations == 1
    assert clean.check_reference(fact, dim, "k", "r").first().violations == 1


@pytest.mark.parametrize(
    "value, cut, case",
    [
        (0.0, "0%", "0%  No discount"),
        (0.0005, "0%", "1–10%"),
        (0.1, "1–10%", "1–10%"),
        (0.2, "11–20%", "11–20%"),
        (0.25, "21–30%", "21–30%"),
        (0.31, ">30%", "> 30%"),
        (1.0, ">30%", "> 30%"),
        (1.5, None, "> 30%"),
        (None, None, "> 30%"),
    ],
)
def test_both_bandings(spark, value, cut, case):
    df = spark.createDataFrame([(value,)], "d double")
    row = df.select(
        columns.band("d", columns.CUT_EDGES, columns.CUT_LABELS).alias("cut"),
        columns.band("d", columns.CASE_EDGES, columns.CASE_LABELS, "case").alias("case"),
    ).first()
    assert (row["cut"], row["case"]) == (cut, case)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (0.5,), (9.0,)], "v double")
    assert [r[0] for r in df.select(columns.clip("v", -1.0, 1.0)).collect()] == [None, -1.0, 0.5, 1.0]


def test_channel_follows_the_key_and_its_shares(spark):
    df = spark.range(10_000).select(F.col("id").alias("order_id"), F.lit(0).cast("bigint").alias("product_id"))
    shares = {r.channel: r["count"] for r in clean.assign_channel(df).groupBy("channel").count().collect()}
    assert shares["website"] == 4500 and shares["mobile_app"] == 3000 and shares["store"] == 2500
    mixed = clean.assign_channel(df.repartition(7)).orderBy("order_id").collect()
    assert mixed == clean.assign_channel(df).orderBy("order_id").collect()


def test_dedup_keeps_the_first_row_of_a_hot_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    kept = clean.dedup_keep_first(df, ["k"], ["n"])
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    rows = {r.k: r.n for r in kept.collect()}
    assert len(rows) == 6001 and rows[-1] == 0


def test_codes_are_alphabetical_and_null_stays_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    rows = {r.x: r.x_enc for r in clean.encode_ordinal(df, ["x"]).collect()}
    assert rows == {"a": 0, "b": 1, "c": 2, None: None}


def test_first_row_and_first_present_value(spark):
    df = spark.createDataFrame(
        [(2, "k", "late", "L"), (1, "k", None, "E"), (3, "k", "late", "L")],
        "row_id bigint, id string, name string, tag string",
    )
    row = star.first_row_per_key(df, "id", ["name", "tag"]).first()
    assert (row.name, row.tag) == (None, "E")
    row = star.first_present_per_key(df, "id", ["name", "tag"]).first()
    assert (row.name, row.tag) == ("late", "E")


def test_null_places_match(spark):
    df = spark.createDataFrame(
        [(1, None, "T", "S", "1"), (2, None, "T", "S", "1"), (3, "A", "T", "S", None)],
        "row_id int, city string, state string, region string, postal_code string",
    )
    keyed = star.attach_geo_key(df, star.dim_geography(df)).orderBy("row_id").collect()
    assert [r.geo_key for r in keyed] == [1, 1, 2]


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    found = {r.column_name: (r.data_type, r.row_count, r.null_count) for r in clean.profile_nulls(df).collect()}
    assert found == {"a": ("int", 2, 0), "b": ("string", 2, 1)}


def test_star_is_written_by_year(spark, lines, tmp_path):
    star_tables = star.star_schema(lines, lambda name, build: build())
    star.write_star(star_tables, str(tmp_path / "star"))
    fact = spark.read.parquet(str(tmp_path / "star" / "fact_sales"))
    assert fact.count() == lines.count()
    one_year = fact.where("order_year = 1998")
    assert "PartitionFilters: [isnotnull(order_year" in one_year._jdf.queryExecution().executedPlan().toString()


def test_rows_whose_key_does_not_repeat_are_not_shuffled(spark):
    """All rows were shuffled with all their columns, though few keys come twice."""
    rows = [("1", "a", "x"), ("1", "a", "w"), ("2", "a", "v"), (None, "a", "u"), (None, "a", "t"), ("3", None, "s"), (None, None, "r")]
    df = spark.createDataFrame(rows, "o string, p string, z string")
    found = sorted(map(str, clean.dedup_wide(df, ["o", "p"], ["z"]).collect()))
    assert found == sorted(map(str, clean.dedup_keep_first(df, ["o", "p"], ["z"]).collect())) and len(found) == 5
    once = clean.dedup_wide(spark.range(50).select(F.col("id").alias("o"), F.col("id").alias("p"), F.lit("x").alias("z")), ["o", "p"], ["z"])
    assert once.count() == 50
    branch = once._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "LeftAnti" in branch and "Window" not in branch


def test_compressed_parts_are_read_by_their_encoding(spark, tmp_path):
    for name, encoding in (("a é", "UTF-8"), ("b é", "ISO-8859-1")):
        df = spark.createDataFrame([(name,)], "n string")
        files.write_csv(df, str(tmp_path / encoding), encoding, "gzip")
    assert list(tmp_path.glob("*/*.csv.gz"))
    assert sorted(row.n for row in files.read_csv(spark, f"{tmp_path}/*").collect()) == ["a é", "b é"]
