import uuid
from types import SimpleNamespace

import pytest

from tephra import session


def test_a_cluster_without_a_shared_folder_is_an_error():
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)
    fake.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)


def test_materialized_tables_live_in_one_run_folder_and_can_be_dropped(spark):
    a, b = (session.materialize(spark.range(n)) for n in (3, 4))
    assert {f.rsplit("/", 2)[0].removeprefix("file://") for df in (a, b) for f in df.inputFiles()} == {session.run_dir(spark).removeprefix("file://")}
    assert (a.count(), b.count()) == (3, 4)
    session.drop_materialized(a)
    assert b.count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(f"{session.run_dir(spark)}/{uuid.uuid4().hex}")
