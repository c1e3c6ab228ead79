import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs(spark):
    """Make documents of (doc_id, text[, lang[, source]]) rows."""

    def make(rows, extra=()):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in full], DOCUMENTS)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture()
def tables(spark, tmp_path):
    """Write tables as a scale-factor folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
