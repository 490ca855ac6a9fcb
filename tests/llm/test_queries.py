"""Registered queries: rows that SQL can give, and a run of every one on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entries
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
DEALT = {f"op{n}_" for n in range(1, 11)}


def test_every_operator_has_one_query():
    names = list(queries.queries())
    assert {n[: n.index("_") + 1] for n in names} == DEALT and len(names) == 10
    assert set(names) | {"pipeline"} <= set(entries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_rows_are_those_of_the_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = c.execute(queries.oracle_sql()[name])
    columns = [x[0] for x in found.description]
    want = sorted(found.fetchall())
    df = queries.queries()[name](spark, SF)
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("op1_pii", "documents", {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"}),
        ("op2_token_files", "documents", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
        ("op3_secrets", "documents", {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}),
        ("op4_exact_dedup", "documents", {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"}),
        ("op5_html", "pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
        ("op6_bpe", "documents", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
        ("op8_minhash", "documents", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}),
        ("op9_language", "documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
        ("op10_vector_join", "embeddings", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    ],
)
def test_one_row_for_each_input_row(spark, name, table, columns):
    df = queries.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in columns} == columns
    rows, source = df.collect(), spark.read.parquet(f"{SF}/{table}.parquet")
    key = next(iter(columns))
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in source.select(key).collect())
    assert not any(r[c] is None for r in rows for c in columns if c != "url")


def test_pieces_have_their_columns(spark):
    kinds = dict(queries.queries()["op7_packing"](spark, SF).dtypes)
    assert {c: kinds[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")} == dict.fromkeys(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), "bigint")
