"""Every training-data query against its SQL in DuckDB, the pipeline included; accuracy where SQL can't say."""

import numpy as np
import pytest

from check_oracles import connect
from compare import ORACLES, QUERIES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, SF, name, con).startswith("ok")


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op10_quality_model"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = scored.merge(labels, on="doc_id").query("held_out")
    assert np.mean(held.predicted == held.quality) > 0.93


def test_pages_against_their_article(spark):
    import html
    import re

    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").toPandas().set_index("page_id").html
    for row in QUERIES["op4_html_extract"](spark, sf).collect():
        inner = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(?:</article>|\Z)", pages[row["page_id"]], re.S)[1])
        parts = [re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", p)) for p in re.split(r"</?(?:p|h1)>", inner)]
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert row["text"] == "\n".join(p for p in want if p)
