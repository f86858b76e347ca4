"""The queries that SQL can express against DuckDB, on the smallest tables
and on the small corpus with its linked pages."""

from __future__ import annotations

import pytest

from bucketvote.llm.oracle import ORACLE
from bucketvote.llm.queries import QUERIES
from tests.compare import compare, duck

from .corpus import documents, texts
from .test_pages import LINKED, PAGES, URLS
from .test_round_three import VECTORS, vectors
from .test_text_operators import ITEMS


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_tables(spark, smoke_dir, name):
    res = compare(spark, duck(smoke_dir), smoke_dir, name, QUERIES[name], ORACLE[name])
    assert res["status"] == "ok", res


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("small"))
    seen, rows = set(), []
    for d, t in texts():  # the SQL keys rows by id
        if d is not None and d not in seen:
            seen.add(d)
            rows.append((d, t))
    tables = {
        "documents": documents(spark, rows),
        "benchmark": spark.createDataFrame([*ITEMS, (77, " ".join(rows[4][1].split()[:30]))], "item_id long, text string"),
        "pages": spark.createDataFrame([*LINKED, *((1000 + i, u, None) for i, u in enumerate(URLS))], PAGES),
    }
    tables["labels"] = spark.createDataFrame([(d, d % 2, int(d % 3 == 0)) for d, _ in rows[::2]], "doc_id long, quality int, toxic int")
    tables["embeddings"] = spark.createDataFrame([r for r in vectors(3, 150)[:156] if r[2]], VECTORS)
    import pyarrow.parquet as pq

    for name, df in tables.items():
        pq.write_table(df.toArrow(), f"{at}/{name}.parquet")
    return at


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_small_corpus(spark, folder, name):
    res = compare(spark, duck(folder), folder, name, QUERIES[name], ORACLE[name])
    assert res["status"] == "ok", res
