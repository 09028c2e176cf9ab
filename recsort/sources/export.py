"""Write records as CSV in several charsets (input for the CSV source keys).

Rows are spread over UTF-8, UTF-8 with a byte-order mark, and GB18030
files by a hash of the id, so a reader has to pick the charset per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.session import scratch_path

BOM = "﻿"


def export_encoded_records(spark: SparkSession, records: DataFrame, root: str | None = None) -> str:
    root = root or scratch_path(spark, "csv-export")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    bucket = F.pmod(F.xxhash64(F.col(records.columns[0])), F.lit(3))
    groups = (("utf8", "UTF-8", False, 0), ("utf8bom", "UTF-8", True, 1), ("gb18030", "GB18030", False, 2))
    for name, charset, bom, b in groups:
        part = records.filter(bucket == b)
        if bom:  # the header is the first line of every part file
            first = part.columns[0]
            part = part.withColumnRenamed(first, BOM + first)
        (part.write.mode("overwrite").option("header", True).option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .option("encoding", charset).csv(f"{root}/{name}"))
    return root
