"""Queries on a stream of files, for tables of one file and for folders of several."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import queries


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    import numpy as np

    vectors = np.random.default_rng(4).normal(size=(60, 64))
    table = pa.table({"vec_id": pa.array(range(60), pa.int64()), "embedding": pa.array(list(vectors), pa.list_(pa.float64()))})
    one, many = tmp_path_factory.mktemp("one"), tmp_path_factory.mktemp("many")
    pq.write_table(table, one / "embeddings.parquet")
    (many / "embeddings.parquet").mkdir()
    for k in range(3):
        pq.write_table(table.slice(20 * k, 20), many / "embeddings.parquet" / f"part-{k:05d}.parquet")
    return str(one), str(many)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("name", ["stream_dict_fit", "stream_dict_fit_one", "stream_traces"])
def test_a_folder_of_files_is_one_table(spark, tables, name):
    one, many = (rows(queries()[name](spark, d)) for d in tables)
    assert len(one) == len(many) > 0
    for a, b in zip(one, many):
        assert a == pytest.approx(b, abs=1e-6)
