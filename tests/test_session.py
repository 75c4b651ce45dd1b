"""Session helpers: settings, checkpoint folder, date."""

from ledgerline.session import SQL_CONF, checkpoint_dir, database_bytes, stored_bytes, today
from ledgerline.sources.tables import TABLE_NAMES, BalanceTables


def test_checkpoint_dir_on_a_local_master(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    # Spark registers a per-application sub-folder under the chosen folder.
    bare = lambda p: p.removeprefix("file:").rstrip("/")
    assert bare(checkpoint_dir(spark)).startswith(bare(d))


def test_today_is_the_session_date(spark):
    assert today(spark) == spark.sql("SELECT current_date()").first()[0]


def test_session_settings_applied(spark):
    for k, v in SQL_CONF.items():
        assert spark.conf.get(k).lower() == v.lower(), k


def test_database_is_sized_by_statistics_locations_or_files(spark, tmp_path):
    """Tables with statistics, without them (partitioned and plain), and a view."""
    spark.sql(f"CREATE DATABASE sized_db LOCATION '{tmp_path / 'db'}'")
    try:
        expected = 0
        for k, name in enumerate(TABLE_NAMES.values()):
            rows = spark.range(1000 * (k + 1)).selectExpr("id", "id % 3 AS part")
            if k == 0:
                rows.write.parquet(str(tmp_path / "plain"))
                spark.sql(f"CREATE VIEW sized_db.{name} AS SELECT * FROM parquet.`{tmp_path / 'plain'}`")
                expected += stored_bytes(spark, str(tmp_path / "plain"))
                continue
            writer = rows.write.partitionBy("part") if k == 1 else rows.write
            writer.option("path", str(tmp_path / name)).saveAsTable(f"sized_db.{name}")
            if k == 2:
                spark.sql(f"ANALYZE TABLE sized_db.{name} COMPUTE STATISTICS")
                stated = spark.sql(f"DESCRIBE TABLE EXTENDED sized_db.{name}").filter("col_name = 'Statistics'").first()["data_type"]
                expected += int(stated.split()[0])
            else:
                expected += stored_bytes(spark, str(tmp_path / name))
        tables = BalanceTables(**{f: spark.table(f"sized_db.{n}") for f, n in TABLE_NAMES.items()})
        got = database_bytes(spark, "sized_db", tables)
        assert expected and abs(got - expected) <= 0.05 * expected
    finally:
        spark.sql("DROP DATABASE sized_db CASCADE")
