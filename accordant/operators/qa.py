"""Second review: sampling, queue, record rules and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.ids import is_sampled
from accordant.functions.numbers import ratio
from accordant.functions.text import is_blank


def qa_queue(cases: DataFrame, reviews: DataFrame, fraction: float = policy.QA_FRACTION) -> DataFrame:
    """Sampled, finished cases without a second review."""
    eligible = cases.where(F.col("status").isin(policy.QA_ELIGIBLE_STATUSES) & is_sampled(F.col("case_id"), fraction))
    return eligible.join(reviews.select("case_id"), "case_id", "left_anti")


def check_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with the first rule they break (null when they are fine)."""
    error = (F.when(~F.coalesce(F.col("verdict").isin(policy.QA_VERDICTS), F.lit(False)),
                    "verdict must be AGREE or DISAGREE")
             .when((F.col("verdict") == "DISAGREE") & is_blank("note"), "A note is required when disagreeing."))
    return reviews.withColumn("error", error)


def qa_columns() -> list[Column]:
    agree, total = F.count_if(F.col("verdict") == "AGREE"), F.count("*")
    return [total.alias("qa_sampled"), agree.alias("agreements"), (total - agree).alias("disagreements"),
            ratio(agree, total, 3).alias("agreement_rate"), ratio(total - agree, total, 3).alias("rework_signal_rate")]


def qa_metrics(reviews: DataFrame) -> DataFrame:
    """Agreement and rework rates; null rates without reviews."""
    return reviews.agg(*qa_columns())
