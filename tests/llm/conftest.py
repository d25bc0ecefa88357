import pytest

#: Rows that every operator on documents must survive: nulls in any column, empty, blank, very long, repeated.
ODD_TEXTS = [None, "", "   \n\t\n ", "12 34 !!", "one", "a b c d e f g h i j k l", "same words here " * 8,
             "x" * 50_000, "long words in one line " * 8_000, "a\n\nb\r\n\tc \x85 d e  f", "中文 \U0001d11e",
             "<|endoftext|> is a text like others", "same words here " * 8]


@pytest.fixture(scope="session")
def code(spark):
    from trestle.llm.common import share_code

    return share_code(spark)


@pytest.fixture(scope="session")
def odd_docs(code):
    """Odd texts with null ids, languages and sources, and columns named like those that operators make."""
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, None, 7, True, "r", -1.0, i)
            for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[5])
    return code.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, kept boolean, "
                                      "rule string, score double, line int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "documents embeddings pages labels".split():
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return con


def table_of(df, key="doc_id"):
    got = {}
    for r in df.collect():
        got.setdefault(r[key], []).append(r.asDict(recursive=True))
    return got
