import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(*rows):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def clashing(docs):
    """Documents with more columns, named as helper columns of the operators are."""

    def build(*rows):
        df = docs(*rows)
        for name in ("size", "order", "repeats", "target", "shard", "range", "key", "class", "text_hash", "content", "sha", "check", "keep_id",
                     "lang_pred", "score", "doc", "n", "base", "found", "norm", "gone_id", "copy", "token", "Source_Key"):
            df = df.selectExpr("*", f"'{name}' AS `{name}`")
        return df

    return build


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))
