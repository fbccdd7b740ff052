"""Small helpers for literal frames."""


def rows(df, *cols):
    """Sorted tuples of a frame."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
