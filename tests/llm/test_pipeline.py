"""Every registered query that has SQL against it, and the pipeline against its parts."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from rinkframe.llm.queries import QUERIES
from tests import oracle

pytestmark = pytest.mark.skipif(not oracle.Path(oracle.DEFAULT).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_its_sql(text_spark, name):
    assert oracle.differences(text_spark, oracle.connect(oracle.DEFAULT), oracle.DEFAULT, QUERIES[name]) is None


def test_entry_point_has_all():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    for n in range(1, 11):
        assert any(x.startswith(f"op{n}_") for x in names)


def test_pipeline_stages(text_spark, tmp_path):
    docs = text_spark.read.parquet(f"{oracle.DEFAULT}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(text_spark, docs, oracle.DEFAULT).write.parquet(str(tmp_path / str(k)))
        docs = text_spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns, name
            sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[4] < sizes[3]
    kept = text_spark.read.parquet(str(tmp_path / "3")).select("doc_id")
    packed = docs.select("doc_id").distinct()
    assert kept.exceptAll(packed).isEmpty() and packed.exceptAll(kept).isEmpty()
    assert Path(oracle.DEFAULT).exists()
