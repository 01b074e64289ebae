import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from datetime import datetime
from tapelake.session import local_session
from tapelake.operators.alerts import price_alerts
spark = local_session("ship", cores=1, shuffle_partitions=1)
rows = [("T1", "A", 100.0, datetime(2024, 1, 1, 0, 0, 0)), ("T2", "A", 110.0, datetime(2024, 1, 1, 0, 1, 1))]
df = spark.createDataFrame(rows, "trade_id string, symbol string, price double, timestamp timestamp")
print("severity", price_alerts(df).collect()[0].severity)
"""


def test_task_code_reaches_workers_without_the_package(tmp_path):
    """Python workers started elsewhere cannot import the package; the driver's path is not theirs."""
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, capture_output=True, text=True, timeout=180
    )
    assert "severity CRITICAL" in done.stdout, done.stderr[-2000:]
