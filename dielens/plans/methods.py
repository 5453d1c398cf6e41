"""Generated code that the JVM compiles."""

from __future__ import annotations

from pyspark.sql import SparkSession

_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_DEFAULT, COMPILED = "65535", "8000"


def compiled_methods(spark: SparkSession) -> None:
    """Lets Spark run stages whose generated method has over 8000 bytes operator by operator.

    HotSpot does not compile larger methods, so the columns and filters of a die table, fused to
    one method, would be interpreted. Spark's documentation names this value for HotSpot. A
    limit the session was given stays.
    """
    if spark.conf.get(_LIMIT, _DEFAULT) == _DEFAULT:
        spark.conf.set(_LIMIT, COMPILED)
