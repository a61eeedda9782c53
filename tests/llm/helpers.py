"""Small frames that every operator must survive."""

import numpy as np
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that the operators use themselves
                     T.StructField("id", T.StringType()), T.StructField("ids", T.StringType()),
                     T.StructField("fp", T.LongType()), T.StructField("label", T.StringType())])


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]) with extra clashing columns."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src1")), len(r[1] or ""), "x", "y", 7, "z") for r in rows]
    return spark.createDataFrame(full, DOCS)


def components_of(near):
    """Smallest index that each row of a boolean matrix reaches."""
    root = np.arange(len(near))
    near = near | np.eye(len(near), dtype=bool)
    while True:
        new = np.array([root[row].min() for row in near]) if len(near) else root
        if (new == root).all():
            return root
        root = new
