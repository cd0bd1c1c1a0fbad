"""The pN_ queries over the smallest tables, against SQL where it can express them."""

import os

import pytest

from test_catalogue import DATA, agree

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_against_sql(spark):
    from curatrix.llm import oracles, queries

    for name, sql in oracles.ORACLES.items():
        agree(spark, queries.QUERIES[name], sql)


def test_columns(spark):
    from curatrix.llm import queries as q

    want = {
        "p1_found": ["dimension", "term", "mark"], "p2_found": ["image_id"], "p3_found": ["image_id", "group_id"], "p4_found": ["phash_cluster_id", "image_id", "qc_image_id"],
        "p5_found": ["text_column", "row_id"], "p8_found": ["doc_id"],
    }
    for name, columns in want.items():
        assert q.QUERIES[name](spark, DATA).columns == columns
    for name in ("p5_found", "p5_source_shares", "p6_packing", "p7_report", "p8_found"):
        assert q.QUERIES[name](spark, DATA).count() > 0
