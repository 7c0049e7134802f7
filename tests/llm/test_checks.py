"""The queries against their SQL checks: on supplied tables, and on small tables of awkward rows."""

import duckdb
import pytest

from tests.test_table_queries import ordered
from threatloom.llm.queries import QUERIES, SQL

TABLES = ["documents", "benchmark", "embeddings", "pages", "labels"]
PASSAGE = " ".join(f"step{i}" for i in range(16))


def compared(spark, folder, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet{'/*.parquet' if folder.startswith('/tmp') else ''}'").fetchall()
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    cursor = connection.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = ordered(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert ordered(tuple(r[c] for c in columns) for r in df.collect()) == expected
    return expected


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = [
        None,
        "",
        " \t\n",
        "Word",
        "é token = 'abc.DEF-1234' tail",
        "PASSWORD:==abcdefgh api_key=short password: password=hunter22x",
        "deadbeef" * 5 + " AKIA" + "A1" * 7 + " AKIA12 " + "0123456789abcdef" * 2,
        "\U0001f600-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36,
        PASSAGE,
        PASSAGE + " and more words",
        PASSAGE.upper(),
        "one two three four five six seven eight nine ten",
        "one two three four five six seven eight nine ten eleven",
    ]
    tables = {
        "documents": ([(i, t, ["en", "fr", None][i % 2 + i % 7 // 6], ["s", "t", None, ""][i % 4], 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"),
        "benchmark": ([(1, PASSAGE), (2, "six seven"), (3, None), (4, "...")], "item_id long, text string"),
        "embeddings": (
            [(1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [1.0, 0.0], None), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, None], 1)]
            + [(7, [1.0, float("nan")], 1), (8, [1.0, 0.0], 2), (9, [3.0, 0.6], 1), (10, [1.0, 0.0, 0.0], 1), (11, [], 1)],
            "vec_id long, embedding array<float>, label int",
        ),
        "pages": (
            [(i, f"https://site.com/blog/{i}/post{i % 30}") for i in range(60)]
            + [(100 + i, f"https://site.com/shop/{'spam' if i % 2 else 'tea'}") for i in range(30)]
            + [(200, None), (201, "no scheme"), (202, "http://A.Example.NET/en/x?y"), (203, "x://example.com/de/#f"), (204, "x://notexample.com/de/")]
            + [(205, "x://www.net"), (206, "x://net/"), (207, "x://a.org/fr/1"), (208, "x://site.com?q=/a"), (209, "http://é.com/É//b/")],
            "page_id long, url string",
        ),
        "labels": ([(100 + i, 1 - i % 2, 0) for i in range(30)] + [(1, None, 0), (2, 0, 1), (2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", list(SQL))
def test_check_on_supplied_tables(spark, name):
    assert compared(spark, "/root/testdata/sf0.01", name)


@pytest.mark.parametrize("name", list(SQL))
def test_check_on_awkward_rows(spark, awkward, name):
    assert compared(spark, awkward, name)


def test_urls_of_a_bad_template_are_blocked(spark, awkward):
    found = {r.page_id: r.verdict for r in QUERIES["op4_url_filter"](spark, awkward).collect()}
    assert found[101] == "block" and found[100] == "allow" and found[0] == "allow"
