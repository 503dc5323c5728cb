"""Landed web-API payloads (S14): one folder per endpoint, JSON files inside.

The HTTP fetch itself is outside the library; what lands is read with a
fixed schema (no inference pass), so a folder of millions of payloads is
one distributed scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake import schemas as S
from cardiolake.sources.json_docs import once

ENDPOINT_SCHEMAS = {
    "activity": S.API_ACTIVITY,
    "sleep": S.API_SLEEP,
    "exercise": S.API_EXERCISE,
    "physical_info": S.API_PHYSICAL,
    "nightly_recharge": S.API_RECHARGE,
}


def read_payloads(spark: SparkSession, root: str, endpoint: str, default_subject: int = 0) -> DataFrame:
    """``<root>/<endpoint>/[subject_id=<n>/]*.json`` -> typed rows + ``subject_id`` + raw text."""
    path = f"{root.rstrip('/')}/{endpoint}"
    schema = ENDPOINT_SCHEMAS[endpoint]
    raw = spark.read.text(path, wholetext=True).withColumnRenamed("value", "json_text")
    subj = (F.col("subject_id").cast("long") if "subject_id" in raw.columns
            else F.lit(default_subject).cast("long"))
    return raw.select(subj.alias("subject_id"), "json_text",
                      once(F.from_json("json_text", schema)).alias("p")).select("subject_id", "json_text", "p.*")
