from datetime import datetime as dt

import pytest

from conftest import rows
from shopgrain.plans.catalogue import catalogue
from shopgrain.sources import tables
from shopgrain.sources.report import write_report
from shopgrain.sources.schemas import SHOP_DDL
from shopgrain.sources.versions import VersionedTables


def test_csv_keeps_null_empty_quotes_and_commas(spark, tmp_path):
    data = [(1, 'a"quoted"@x', "Last, First", None, "", dt(2024, 1, 1, 1, 2, 3)),
            (2, "b@x", "Çağlar Öz", "+90", None, dt(2024, 1, 1))]
    df = spark.createDataFrame(data, SHOP_DDL["users"])
    tables.write_csv(df, str(tmp_path / "users"), "users")
    assert rows(tables.read_csv(spark, str(tmp_path / "users"), "users")) == rows(df)


def test_csv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a@x", "two\nlines", None, "Rome", dt(2024, 1, 1))],
                               SHOP_DDL["users"])
    tables.write_csv(df, str(tmp_path / "users"), "users")
    assert rows(tables.read_csv(spark, str(tmp_path / "users"), "users", True)) == rows(df)


def test_csv_in_the_source_format(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        '1,"a@x","A ""B"" C",\\N,"Rome","2024-01-01T00:00:00"\n'
        '2,"b@x","D",\\N,\\N,"2024-02-01T10:30:00"\n')
    got = rows(tables.read_csv(spark, str(tmp_path / "c.csv"), "users"))
    assert got == [(1, "a@x", 'A "B" C', None, "Rome", dt(2024, 1, 1)),
                   (2, "b@x", "D", None, None, dt(2024, 2, 1, 10, 30))]


def test_csv_with_a_bad_number_fails(spark, tmp_path):
    (tmp_path / "c.csv").write_text('x,"n","s"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(tmp_path / "c.csv"), "categories").collect()


def test_incomplete_version_is_ignored(spark, tmp_path):
    stored = VersionedTables(spark, str(tmp_path))
    assert not stored.exists("t")
    with pytest.raises(FileNotFoundError):
        stored.read("t")
    stored.write("t", spark.range(3))
    stored.write("t", spark.range(5))
    (tmp_path / "t" / "v000002" / "_SUCCESS").unlink()
    assert stored.read("t").count() == 3
    assert stored.write("t", spark.range(7)).count() == 7
    assert not (tmp_path / "t" / "v000003").exists()


def test_version_is_built_from_the_one_before(spark, tmp_path):
    stored = VersionedTables(spark, str(tmp_path))
    stored.write("t", spark.range(3))
    assert stored.write("t", stored.read("t").selectExpr("id + 1 AS id")).count() == 3
    assert rows(stored.read("t")) == [(1,), (2,), (3,)]


def test_stored_shop_equals_the_roles(spark, shop, tmp_path):
    tables.write_parquet_shop(shop, str(tmp_path))
    stored = tables.read_parquet_shop(spark, str(tmp_path))
    for name in SHOP_DDL:
        assert stored.table(name).dtypes == shop.table(name).dtypes, name
        assert stored.table(name).count() == shop.table(name).count(), name


def test_unknown_table(shop):
    with pytest.raises(AttributeError):
        shop.nothing


def test_catalogue_has_fifty_questions():
    numbers = [c.number for c in catalogue()]
    assert numbers == list(range(1, 51))


def test_report_keeps_order_and_limit(shop, tmp_path):
    wanted = [c for c in catalogue("2001-09-01 00:00:00") if c.number in (6, 14, 27)]
    report = write_report(wanted, shop, str(tmp_path / "report"))
    months = [r.row for r in report.where("question_id = 6").orderBy("position").collect()]
    assert len(months) == 10 and '"sales_month":"1995-01-01"' in months[0]
    assert '"prev_month_revenue":null' in months[0]
    assert report.where("question_id = 27").count() <= 5
