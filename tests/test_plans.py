from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from tidemart.plans.oracle import check_sql
from tidemart.session import cluster_settings

ROOT = Path(__file__).parent.parent


def test_queries_and_sql_load_without_a_session():
    text = "import __spark_entry__ as e; print(len(e.queries()) > 100, len(e.oracle_sql()) > 100)"
    done = subprocess.run([sys.executable, "-c", text], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.strip() == "True True", done.stderr


def test_entry_has_rows(spark, sf):
    sys.path.insert(0, str(ROOT))
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 20


def test_check_sql_takes_only_what_is_named():
    assert check_sql("select 1 from lineitem") == "select 1 from lineitem"
    text = check_sql("select * from customer_orders")
    assert text.index("stg_orders as") < text.index("spend as") < text.index("customer_orders as")
    assert "lineitem" not in text


def test_partition_count_follows_the_input():
    assert cluster_settings(1)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(10 * 2**40)["spark.sql.shuffle.partitions"] == str(10 * 2**13)
    assert cluster_settings(100 * 2**40)["spark.sql.shuffle.partitions"] == str(100 * 2**13)
