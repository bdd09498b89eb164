"""Report sink: the first rows of every question, as JSON lines in one Parquet data set."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.plans.catalogue import Question
from shopgrain.session import materialise
from shopgrain.sources.tables import Shop


def report_rows(
    question: Question, shop: Shop, rows: int = 10, made: DataFrame | None = None
) -> DataFrame:
    """(name, title, position, row) for the first `rows` rows, so the window holds `rows` rows."""
    top = question.report(shop, rows, made)
    order = question.order_by() or [F.lit(0)]
    return top.select(
        F.lit(question.name).alias("name"), F.lit(question.title).alias("title"),
        F.row_number().over(W.orderBy(*order)).alias("position"),
        F.to_json(F.struct(*top.columns), {"ignoreNullFields": "false"}).alias("row"),
    )


def write_report(
    questions: Iterable[Question], shop: Shop, path: str, rows: int = 10, at_once: int = 4
) -> DataFrame:
    """Run every question and store its rows under `question_id=<number>`.

    The questions are independent, so a few run at once and fill each other's idle tasks. One
    that fails can be written again without the others. What several of them have in common is
    computed and written once.
    """
    spark, questions = shop.orders.sparkSession, list(questions)
    common = {c: materialise(c(shop), "report") for c in {
        question.common for question in questions if question.common}}

    def write(question: Question) -> None:
        made = common.get(question.common)
        report_rows(question, shop, rows, made).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/question_id={question.number}"
        )

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(write, questions))
    return spark.read.parquet(path)
