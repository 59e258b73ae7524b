"""What the plans must look like to hold at scale."""

import re

from pyspark.sql import functions as F

from riverload import stages
from riverload.fixtures import view
from riverload.functions.joins import null_safe_join
from riverload.operators import cleaning, loads
from riverload.plans import pollutant_loads

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    explain = df.sparkSession._jvm.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")


def test_latest_deposit_is_chosen_before_the_shuffle(spark):
    text = plan(cleaning.keep_latest(view(spark, SF, "measure")))
    order = [m for m in re.findall(r"WindowGroupLimit|Exchange", text)]
    assert order == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_cleaning_reads_needed_columns_and_rows(spark, tmp_path):
    path = str(tmp_path / "measure")
    view(spark, SF, "measure").write.parquet(path)
    measure = spark.read.schema(view(spark, SF, "measure").schema).parquet(path)
    text = formatted(loads.concentrations(
        cleaning.clean_measures(loads.needed_measures(measure.where("kind = 'STEP'"))),
        cleaning.parameter_dimension(view(spark, SF, "parameter_dim"))))
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", text).group(1)
    assert "EqualTo(kind,STEP)" in pushed and "In(Pt_SANDRE" in pushed
    assert "In(Code_sandre_parametre" in pushed


def test_pollutants_are_spread_after_the_shuffles(spark):
    measures = pollutant_loads.prepared_measures(view(spark, SF, "measure"), "STEP")
    params = cleaning.parameter_dimension(view(spark, SF, "parameter_dim"))
    flagged = loads.flagged_days(loads.flow_days(loads.daily_flow(measures)),
                                 loads.concentrations(measures, params))
    text = plan(loads.zero_flow_days(flagged, params))
    before = text[:text.index("BroadcastNestedLoopJoin")]
    assert "Exchange" not in before


def test_missing_key_group_is_split(spark):
    """A third of the rows without key: the adaptive skew join splits that group."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 300_000, 1, 8).selectExpr(
            "if(id % 3 = 0, null, concat('k', id)) AS k", "uuid() AS filler")
        right = spark.range(50_000).selectExpr("if(id = 0, null, concat('k', id)) AS k", "id AS y")
        joined = null_safe_join(left, right, "k", "left")
        counted = joined.groupBy("y").agg(F.max("filler"))
        counted.collect()
        assert "skew=true" in plan(counted)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stages_use_the_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert stages.stage_root(spark) == root
    written = stages.Stages(spark, "t").write(spark.range(3), "x")
    assert written.count() == 3 and written.inputFiles()[0].startswith(f"file://{root}/t-")


def test_without_setting_stages_are_below_the_warehouse():
    class Conf:
        def get(self, key, default=None):
            return "hdfs:/warehouse/" if key == "spark.sql.warehouse.dir" else default

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return Conf()

    assert stages.stage_root(Fake) == "hdfs:/warehouse/_stages"


def test_days_are_never_gathered_for_a_broadcast(spark):
    """Written stages compress well, so Spark takes the days for small; only the nine pollutants are sent to all tasks."""
    measures = pollutant_loads.prepared_measures(view(spark, SF, "measure"), "STEP")
    params = cleaning.parameter_dimension(view(spark, SF, "parameter_dim"))
    days, conc = loads.flow_and_concentrations(measures, params)
    measured = loads.measured_load(days, conc, params, "x")
    for text in (plan(measured), plan(loads.impute_plant_load(loads.flagged_days(days, conc), loads.flow_weighted_ratio(measured), params))):
        assert not re.search(r"BroadcastHashJoin \[coalesce\(Code_SANDRE", text)
        assert re.search(r"SortMergeJoin \[coalesce\(Code_SANDRE", text)
