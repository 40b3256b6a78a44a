"""The command-line driver: full load, daily restatement, a view from the written facts."""

import pytest

from conftest import SF_SMALL
from costlake.plans.run import main
from costlake.plans.sinks import partitions, read_table
from costlake.sources.dims import SCHEMAS, SEEDS
from costlake.sources.fixture import cur_from_lineitem


def test_cli_full_incremental_view(spark, tmp_path):
    cur = str(tmp_path / "cur")
    cur_from_lineitem(spark, SF_SMALL).write.partitionBy("year", "month").parquet(cur)
    usage, bill, out = str(tmp_path / "usage"), str(tmp_path / "bill"), str(tmp_path / "iceberg")
    for name, seed in SEEDS.items():
        spark.createDataFrame(seed, SCHEMAS[name]).write.parquet(str(tmp_path / "dims" / f"{name}.parquet"))
    common = ["--cur", cur, "--usage", usage, "--bill", bill, "--as-of", "2001-11-04"]
    with pytest.raises(SystemExit):
        main(["full", *common], spark)          # no silent seeds
    common += ["--dims", f"file://{tmp_path}/dims"]
    assert main(["full", *common], spark)["mode"] == "full"
    days = partitions(spark, usage, "date")
    assert days[0] >= "1999-11-04" and days[-1] <= "2001-11-04"
    def rows(path):
        df = read_table(spark, path)
        out = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]
        return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

    before_usage, before_bill = rows(usage), rows(bill)
    res = main(["incremental", *common], spark)
    assert res["dropped_days"] == [] and partitions(spark, usage, "date") == days
    # restating unchanged data changes nothing: incremental after full == full
    assert rows(usage) == before_usage and rows(bill) == before_bill
    main(["view", "discount_iceberg", "--usage", usage, "--bill", bill, "--out", out, "--as-of", "2001-11-04"], spark)
    assert read_table(spark, out).count() > 0
    main(["view", "buying_efficiency", *common[2:], "--out", f"{out}-buy"], spark)
    assert read_table(spark, f"{out}-buy").count() > 0
