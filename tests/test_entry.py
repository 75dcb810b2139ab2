import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from casegrid.sources.materialize import checkpoint_folder


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "case_id"


def test_what_corpus_operators_lack_leaves_the_rest_whole():
    """Without a package that only the corpus operators need, the other queries are all there."""
    code = "import sys, warnings; warnings.simplefilter('ignore'); sys.modules['xxhash'] = sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; from casegrid import catalogue; assert set(e.queries()) == set(catalogue.queries()) and set(e.oracle_sql()) == set(catalogue.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)


def test_no_folder_of_one_machine_on_a_cluster():
    """Only a local session may go without a folder that executors share."""
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda name, other: other))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_folder(cluster)
