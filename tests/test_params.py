"""Parameter contract cases."""
import pytest

from hitlog import hits_df, micro_rows
from pathfold import JobParams, date_to_epoch_ms
from pathfold.operators.segments import segment_filter
from pathfold.params import parse_cli_options
from pathfold.plans import reports

BASE = dict(project_id=1, date_start="2019-01-01", date_finish="2019-02-01",
            target_numbers=(3,), source_platform=("ga",))


def test_moscow_midnight():
    assert date_to_epoch_ms("2019-01-01") == 1546290000000
    assert date_to_epoch_ms("2019-01-01", "+03:00") == 1546290000000
    assert date_to_epoch_ms("2024-01-10") == 1704834000000


def test_loose_dates_take_first_date():
    assert date_to_epoch_ms("from 2019-01-01 on", strict=False) == 1546290000000
    with pytest.raises(ValueError):
        date_to_epoch_ms("from 2019-01-01 on", strict=True)
    with pytest.raises(ValueError):
        date_to_epoch_ms("yesterday", strict=False)


def test_start_must_precede_finish():
    with pytest.raises(ValueError):
        JobParams(**{**BASE, "date_finish": "2019-01-01"}).validate()


def test_lookback_must_not_follow_start():
    with pytest.raises(ValueError):
        JobParams(**{**BASE, "date_lookback": "2019-01-02"}).validate()
    JobParams(**{**BASE, "date_lookback": "2019-01-01"}).validate()


def test_achieve_mode_values():
    with pytest.raises(ValueError):
        JobParams(**{**BASE, "achieve_mode": "maybe"}).validate()
    with pytest.raises(ValueError):
        segment_filter(mode="other")


@pytest.mark.parametrize("product", ["", "null", None, "  "])
def test_empty_product_means_no_filter(product):
    assert JobParams(**{**BASE, "product_name": product}).product is None


def test_product_filter(spark):
    from hitlog import hit
    rows = micro_rows() + [hit("c9", "Z", 150, 3, ga_location="other")]
    p = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5),
                  source_platform=("ga",), product_name="p1")
    clients = {r.ClientID for r in reports.detail_report(hits_df(spark, rows), p).collect()}
    assert "c9" not in clients and "c1" in clients
    p_all = JobParams(**{**p.__dict__, "product_name": "null"})
    assert "c9" in {r.ClientID for r in reports.detail_report(hits_df(spark, rows), p_all).collect()}


def test_options_contract():
    opts = parse_cli_options([
        "--projectID=3", "--date_start=2024-01-10", "--date_tHOLD=2024-01-05", "--date_finish=2024-01-28",
        "--target_numbers=3, 5", "--product_name=null", "--source_platform=ga,bq", "--achieve_mode=true",
        "--flat_path=/a,/b", "--output_path=/o", "--output_pathD=/d", "positional"])
    p = JobParams.from_options(opts).validate()
    assert p.target_numbers == (3, 5) and p.source_platform == ("ga", "bq")
    assert p.flat_path == ("/a", "/b") and p.product is None
    assert (p.lookback_ms, p.start_ms, p.finish_ms) == (1704402000000, 1704834000000, 1706389200000)
    with pytest.raises(ValueError):
        JobParams.from_options({k: v for k, v in opts.items() if k != "output_pathD"})
    with pytest.raises(ValueError):
        JobParams.from_options({**opts, "target_numbers": "3,x"})
    with pytest.raises(ValueError):
        parse_cli_options(["--a=b=c"])


def test_pivot_report_name():
    p = JobParams(**{**BASE, "target_numbers": (3, 5), "product_name": "p1"})
    assert p.report_name() == "1_2019-01-01_2019-02-01_p1_3;5"


def test_cluster_conf_sizes_partitions():
    from pathfold.session import cluster_conf
    assert cluster_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"
    conf = cluster_conf(100 * (1 << 40))  # 100 TiB
    assert conf["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (256 << 20))
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_shared_dir_falls_back_only_when_unset_and_local():
    import os

    from pathfold.session import shared_dir

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Ctx:
        def __init__(self, master):
            self.dir, self.master = None, master

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, value, master="local[2]"):
            self.conf, self.sparkContext = Conf(value), Ctx(master)

    assert shared_dir(Session("hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"
    s = Session(None)
    d = shared_dir(s)
    assert os.path.isdir(d) and s.sparkContext.dir == d
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(Session(None, master))
        assert shared_dir(Session("hdfs:///shared/ckpt", master)) == "hdfs:///shared/ckpt"


def test_tuning_values_are_checked():
    with pytest.raises(ValueError):
        JobParams(**{**BASE, "heavy_share": 0})
    with pytest.raises(ValueError):
        JobParams(**{**BASE, "target_numbers": ()})
    p = JobParams(**{**BASE, "heavy_share": 5, "day_partition": "dt"})
    assert (p.heavy_share, p.day_partition) == (5, "dt")


@pytest.mark.parametrize("arg", ["--zone=", "--=x", "--zone"])
def test_options_need_a_name_and_a_value(arg):
    with pytest.raises(ValueError):
        parse_cli_options([arg])
