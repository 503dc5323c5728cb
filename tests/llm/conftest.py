import pytest
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _row string"


def rows_of(df: DataFrame, *names: str) -> list[tuple]:
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.fixture
def make_docs(spark, tmp_path):
    """Documents written as Parquet and read back; columns with names the operators use inside are added."""
    count = [0]

    def make(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        rows = [(ids[i] if ids else i, texts[i], langs[i] if langs else None, sources[i] if sources else None,
                 None if texts[i] is None else len(texts[i]), "s", "r") for i in range(n)]
        count[0] += 1
        path = str(tmp_path / f"docs{count[0]}")
        spark.createDataFrame(rows, SCHEMA).write.parquet(path)
        return spark.read.parquet(path)

    return make
