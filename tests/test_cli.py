"""Both jobs through the command line, in a separate process (own session)."""

import os
import subprocess
import sys
from pathlib import Path

from tests.test_pipeline import DICTIONARY, RAW

ROOT = Path(__file__).resolve().parents[1]


def test_cli_runs_both_jobs(spark, tmp_path):
    files = {}
    for name, text in RAW.items():
        p = tmp_path / f"{name}.csv"
        p.write_text(text, encoding="utf-8")
        files[name] = str(p)
    (tmp_path / "cat.csv").write_text(DICTIONARY, encoding="utf-8")
    ceps = str(tmp_path / "ceps.parquet")
    out = str(tmp_path / "processed")
    env = dict(os.environ, PYTHONPATH=str(ROOT), SPARK_LOCAL_IP="127.0.0.1")
    run = [sys.executable, "-m", "storefront_etl.plans.jobs"]
    subprocess.run(run + ["postcodes", files["postcode_ranges"], ceps], check=True, env=env,
                   cwd=tmp_path, timeout=300, capture_output=True)
    subprocess.run(run + ["pipeline", files["customers"], files["geolocation"], files["order_items"],
                          files["order_payments"], files["order_reviews"], files["orders"],
                          files["products"], files["sellers"], str(tmp_path / "cat.csv"), ceps, out],
                   check=True, env=env, cwd=tmp_path, timeout=300, capture_output=True)
    written = sorted(p.name for p in Path(out).iterdir())
    assert written == sorted(f"{t}.parquet" for t in (
        "customers", "geolocation", "order_items", "order_payments", "order_reviews", "orders",
        "products", "sellers", "product_category"))
    assert spark.read.parquet(f"{out}/customers.parquet").count() == 4
    bad = subprocess.run(run + ["pipeline", "x"], env=env, cwd=tmp_path, timeout=300, capture_output=True)
    assert bad.returncode != 0 and b"usage" in bad.stderr
