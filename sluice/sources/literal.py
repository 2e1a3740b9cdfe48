"""Small literal frames built from JVM-side literals.

``spark.createDataFrame(list)`` ships pickled rows through Python workers; for
the handful of metadata rows the library writes (rule documents, commit and
refresh log rows) an ``inline(array(struct(...)))`` over a one-row range stays
in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[(F.lit(v) if v is not None else F.lit(None)).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
