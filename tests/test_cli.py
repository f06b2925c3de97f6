"""End to end: fixture tables written as Parquet, the run started as a
program, published tables read back."""

import domain_fixture as fx
from quayside.__main__ import main
from quayside.sources.sinks import read_published


def test_cli_run_from_parquet(spark, tmp_path):
    src, dims = fx.sources(spark)
    for name, df in src.items():
        df.write.parquet(str(tmp_path / "src" / f"{name}.parquet"))
    for name, df in dims.items():
        df.write.parquet(str(tmp_path / "dim" / f"{name}.parquet"))
    counts = main(["--sources", str(tmp_path / "src"), "--dimensions", str(tmp_path / "dim"),
                   "--warehouse", str(tmp_path / "wh"), "--run-seq", "7", "--as-of", fx.AS_OF.isoformat()])
    assert counts == {"rsa_rtl_ams": 3, "rsa_rtl_dealer": 4, "rsa_rtl_ivr": 4, "rsa_rtl_vms": 3,
                      "rsa_rtl_vessel": 4, "quarantine": 2}
    assert read_published(spark, str(tmp_path / "wh"), "rsa_rtl_vessel").count() == 4


def test_a_renamed_source_column_raises(spark, tmp_path):
    import pytest
    from quayside.sources.schemas import SOURCES, struct
    from quayside.sources.tables import read_table

    src, _ = fx.sources(spark)
    src["images"].withColumnRenamed("serial_num", "serial").write.parquet(str(tmp_path / "images.parquet"))
    with pytest.raises(ValueError, match="serial_num"):
        read_table(spark, str(tmp_path), "images", struct(SOURCES["images"]))
