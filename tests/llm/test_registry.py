from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    2: "doc_id keep_id group_size kept text_sha256",
    3: "doc_id n_words n_base first_word last_word base_labels labels score",
    4: "doc_id held_out score predicted",
    5: "doc_id n_words n_hit n_items items_sha256 contaminated",
    6: "doc_id fingerprint component_id",
    7: "doc_id n_words n_removed kept_sha256",
    8: "doc_id held_out lang_pred score",
    9: "page_id host path rule verdict",
    10: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


def test_every_operator_is_registered():
    known = entry.queries()
    assert {name.split("_")[0] for name in known if name.startswith("op")} == {f"op{n}" for n in range(1, 11)} and "pipeline" in known


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_the_stated_columns(spark, name):
    got = queries.QUERIES[name](spark, SF)
    n = int(name[2:].split("_")[0]) if name.startswith("op") else 0
    assert set(COLUMNS.get(n, "").split()) <= set(got.columns)
    table = "pages" if "page_id" in got.columns else "documents"
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in queries.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        columns = sorted(got.columns)
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
        assert sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == sorted(want, key=repr)
