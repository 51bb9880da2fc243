from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hourly_star.operators import upsert
from hourly_star.session import instant, partition_overwrite, prepare, shared_dir, stage


def test_shared_dir_is_the_one_the_cluster_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class Cluster:
    """A session on a cluster where nobody named a shared folder."""

    master = "spark://host:7077"

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default: default)

    def getCheckpointDir(self):  # noqa: N802
        return None

    @property
    def sparkContext(self):  # noqa: N802
        return self


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())


def test_prepare_puts_the_zone_right(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_instants_are_utc(spark):
    plus2 = timezone(timedelta(hours=2))
    row = spark.range(1).select(*[
        instant(t).cast("string") for t in (
            datetime(2026, 1, 1, 5), datetime(2026, 1, 1, 7, tzinfo=plus2), "2026-01-01 05:00:00")
    ]).first()
    assert set(row) == {"2026-01-01 05:00:00"}


def test_overwrite_mode_is_put_back(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), partition_overwrite(spark, "dynamic"):
        assert spark.conf.get(key) == "dynamic"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_staged_rows_do_not_depend_on_their_source(spark, tmp_path):
    df = stage(spark.range(5), f"{shared_dir(spark)}/staged_{tmp_path.name}")
    assert df.count() == 5 and df.columns == ["id"]


def test_days_are_listed_or_joined(spark, monkeypatch):
    rows = spark.range(10).select(F.expr("date_add(DATE'2026-01-01', cast(id as int))").alias("utc_date"))
    days = rows.filter("utc_date >= DATE'2026-01-08'")
    listed = upsert.in_days(rows, days).count()
    monkeypatch.setattr(upsert, "MAX_LISTED_DAYS", 2)
    assert upsert.in_days(rows, days).count() == listed == 3
