import math


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def rows_of(spark, data, schema):
    return spark.createDataFrame(data, schema)
