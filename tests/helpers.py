"""Shared by tests; imported as ``tests.helpers``, which no other conftest can shadow."""


def files_df(spark, docs, subject=0):
    """[(file_name, text or bytes)] -> files DataFrame (subject_id, file_name, content binary)."""
    rows = [(subject, n, t.encode("utf-8") if isinstance(t, str) else t) for n, t in docs]
    return spark.createDataFrame(rows, "subject_id long, file_name string, content binary")
