"""Incremental load (exactly-once file sink) and the shared scratch folder."""

import os

from fixtures import HEADER, ROWS, write_lines
from meterwise import session
from meterwise.streaming.ingest import ingest_available


def test_ingest_only_new_files(spark, out):
    landing, target, ckpt = (os.path.join(out, d) for d in ("landing", "parquet", "ckpt"))
    write_lines(os.path.join(landing, "part-1.csv"), [HEADER] + ROWS[:6])
    first = ingest_available(spark, landing, target, ckpt).count()
    assert first == 6
    # A re-run with nothing new appends nothing; a new file adds only its rows.
    assert ingest_available(spark, landing, target, ckpt).count() == 6
    write_lines(os.path.join(landing, "part-2.csv"), [HEADER] + ROWS[6:])
    assert ingest_available(spark, landing, target, ckpt).count() == 6 + len(ROWS[6:]) - 4


def test_ingest_by_default_finds_its_checkpoint_again(spark, out):
    landing, target = (os.path.join(out, d) for d in ("landing", "parquet"))
    write_lines(os.path.join(landing, "part-1.csv"), [HEADER] + ROWS[:1])
    assert ingest_available(spark, landing, target).count() == 1
    write_lines(os.path.join(landing, "part-2.csv"), [HEADER] + ROWS[1:3])
    assert ingest_available(spark, landing, target).count() == 3


def test_scratch_paths_are_unique_and_under_checkpoint_dir(spark):
    base = session.ensure_checkpoint_dir(spark)
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))


def test_cluster_defaults_applied(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
