"""Incremental landing lands each dropped file exactly once."""

import os
import subprocess
import sys

from ledgerline.session import scratch_path
from ledgerline.streaming import land_new_files
from tests.conftest import ROOT


def _drop(local_dir, name, text):
    os.makedirs(local_dir, exist_ok=True)
    with open(os.path.join(local_dir, name), "w") as fh:
        fh.write(text)


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_available_now_lands_new_files_once(spark):
    src = scratch_path(spark, "drops")
    tgt = scratch_path(spark, "landed")
    ckpt = scratch_path(spark, "landing-ckpt")
    _drop(_local(src), "m1.csv", "product_id,id_web\n1,15298.0\n2,abc\n")
    land_new_files(spark, src, tgt, "liaison", checkpoint_path=ckpt)
    assert spark.read.parquet(tgt).count() == 2
    # a rerun with nothing new adds nothing
    land_new_files(spark, src, tgt, "liaison", checkpoint_path=ckpt)
    assert spark.read.parquet(tgt).count() == 2
    _drop(_local(src), "m2.csv", "product_id,id_web\n3,7\n,8\n")
    land_new_files(spark, src, tgt, "liaison", checkpoint_path=ckpt)
    rows = sorted((r["product_id"] or 0, r["id_web"]) for r in spark.read.parquet(tgt).collect())
    assert rows == [(0, "8"), (1, "15298"), (2, "abc"), (3, "7")]


def test_two_processes_land_every_file_once(spark, tmp_path):
    """The default checkpoint belongs to the target: a second application goes on where the first stopped."""
    src, tgt = str(tmp_path / "drops"), str(tmp_path / "landed")
    command = [sys.executable, "-m", "ledgerline", "land", "--source", src, "--target", tgt, "--name", "liaison"]
    env = os.environ | {"PYTHONPATH": ROOT}
    for name, text in (("m1.csv", "product_id,id_web\n1,15298.0\n2,abc\n"), ("m2.csv", "product_id,id_web\n3,7\n,8\n")):
        _drop(src, name, text)
        subprocess.run(command, check=True, cwd=tmp_path, env=env, timeout=240, capture_output=True)
    rows = sorted((r["product_id"] or 0, r["id_web"]) for r in spark.read.parquet(tgt).collect())
    assert rows == [(0, "8"), (1, "15298"), (2, "abc"), (3, "7")]

