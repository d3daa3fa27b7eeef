import pytest
from pyspark.sql import Row, functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source, lang), dealt over a few partitions."""

    def make(rows, extra=None):
        full = []
        for r in rows:
            doc_id, text, source, lang = (*r, *(None,) * 4)[:4]
            full.append(Row(doc_id=doc_id, text=text, lang=lang, source=source, n_chars=None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA).repartition(3) if full else spark.createDataFrame([], SCHEMA)
        for name in extra or []:
            df = df.withColumn(name, F.lit(f"clash {name}"))
        return df

    return make
