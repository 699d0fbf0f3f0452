"""The text operators that SQL can express, against their DuckDB SQL."""

from __future__ import annotations

import pytest
from oracle import assert_equal

from skyloom.llm.queries import ORACLE_SQL, QUERIES
from skyloom.session import table


#: Rows at sf0.001, where they are not its documents.
ROWS = {"op12_prefix_trie": 47}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, sf_dir, name):
    assert assert_equal(QUERIES[name](spark, sf_dir), ORACLE_SQL[name], sf_dir) == ROWS.get(name, 200)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL.keys() - ROWS.keys()))
def test_odd_rows(spark, sf_dir, tmp_path, name):
    line = "the cat of the house is in a garden and that is for the dog with it "
    odd = [None, "", " \t\n", "abc", "one two", "two words here now", "one two", line, line + "now", line * 9, f"{line}\n" * 5, f"# {line}\n|\n" * 30, "ÉÀ ß 中文 \U0001f600 " * 12]
    rows = [(10_000 + 3 * i, text, ("en", "fr", None)[i % 3]) for i, text in enumerate(odd)]
    added = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").limit(60).unionByName(added)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert assert_equal(QUERIES[name](spark, str(tmp_path)), ORACLE_SQL[name], str(tmp_path), ("documents",)) == 73
