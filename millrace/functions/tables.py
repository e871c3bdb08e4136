"""Set-returning functions for SQL text: registered on the session, inlined by the optimizer."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def register_table_function(spark: SparkSession, name: str, parameters: str, columns: str, body: str, **frames: DataFrame) -> None:
    """Make ``name(parameters)`` a function that gives rows of ``columns`` in SQL text of this session.

    ``body`` is a SELECT over the parameters and the frames, which stand as ``{frame}``. It becomes part of the calling query's plan:
    filters and joins on its result reach its tables, and a call for each row of a table is a join.
    """
    views = {}
    for frame, df in frames.items():
        views[frame] = f"{name}_{frame}_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(views[frame])
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body.format(**views)}")
