"""One local session for all tests."""

from __future__ import annotations

import tempfile

from plumbline.session import build_session


def local_session():
    spark = build_session("plumbline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="plumbline-tests-")})
    spark.sparkContext.setLogLevel("ERROR")
    return spark
