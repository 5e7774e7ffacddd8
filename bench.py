"""Headline timings; prints one JSON line. Every step is timed cold, in the order a user runs them."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from registry import spark_queries
from wordloom.plans import models, predict

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(*frames) -> None:
    for frame in frames:
        frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("wordloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    made: dict = {}

    def timed(name, step):
        start = time.perf_counter()
        made[name] = step()
        times[name] = round(time.perf_counter() - start, 3)

    docs = spark_queries.documents(spark, SF_DIR)
    timed("count_ngrams_1_to_4", lambda: models.train_counts(docs, 4))
    tables = made["count_ngrams_1_to_4"]
    timed("sample_train_test", lambda: drain(spark_queries.sample_train_test(spark, SF_DIR)))
    timed("index_words", lambda: drain(spark_queries.ranking.index_words(tables[1])))
    timed("mle_model", lambda: models.save_model(models.mle_model(tables=tables, max_n=4)))
    timed("interpolated_model", lambda: models.save_model(models.interpolated_model(tables=tables)))

    def kn_model():
        model = models.kn_model(tables=tables)
        drain(*[model[name] for name in model if name not in ("unigrams", "bigrams", "trigrams")])

    timed("kn_model", kn_model)
    timed(
        "indexed_tables",
        lambda: drain(*models.indexed_tables(*[tables[n] for n in (1, 2, 3, 4)]).values()),
    )
    phrases = spark_queries.phrases(spark, SF_DIR)
    mle, interpolated = made["mle_model"], made["interpolated_model"]
    timed("predict_backoff_trigram", lambda: drain(predict.predict_backoff(phrases, mle, 3)))
    timed("predict_backoff_tetragram", lambda: drain(predict.predict_backoff(phrases, mle, 4)))
    timed("predict_interpolated", lambda: drain(predict.predict_interpolated(phrases, interpolated)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
