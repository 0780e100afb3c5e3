import os

import pytest

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from charloom.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]").appName("charloom-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


TEXT = [
    "Time is short, and the work is long.",
    "",
    "A ship in harbour is safe — but that is not what ships are built for.",
    "x",
    "",
    "abcdefghijklmnopqrstuvwxyz0123",
    "The quick brown fox jumps over the lazy dog; the dog sleeps on.",
]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(0, "\n".join(TEXT[:3])), (1, "\r\n".join(TEXT[3:5])), (2, "\n".join(TEXT[5:])),
            (3, "z" * 26 + "\n" + "y" * 27), (4, "\n\n")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")
