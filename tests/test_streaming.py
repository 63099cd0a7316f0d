"""The landing stream re-stages each snapshot that receives files."""

import os
import shutil
import tempfile

from conftest import FIXTURES
from hirescope.sources import offers as S
from hirescope.streaming import landing


def _land(root, dt):
    d = os.path.join(root, f"dt={dt}")
    os.makedirs(d, exist_ok=True)
    shutil.copy(os.path.join(FIXTURES, "raw_offers.jsonl"), os.path.join(d, "offers.jsonl"))


def test_stream_restages_touched_snapshots(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-stream-")
    land, stage, ckpt = (os.path.join(tmp, x) for x in ("landing", "stage", "ckpt"))
    _land(land, "2024-03-04")
    q = landing.start(spark, land, stage, ckpt)
    q.awaitTermination(300)
    assert S.read_stage(spark, stage).count() == 7

    _land(land, "2024-03-11")
    q = landing.start(spark, land, stage, ckpt)
    q.awaitTermination(300)
    lake = S.lake_table(spark, stage)
    assert sorted(str(r.dt) for r in lake.select("dt").distinct().collect()) == ["2024-03-04", "2024-03-11"]
    assert lake.count() == 14
