"""Run by tests/test_job.py in its own JVM: the shipped entry point under a plain session."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrameWriter, SparkSession  # noqa: E402

from visitmap import job  # noqa: E402
from visitmap.sources import load_inputs  # noqa: E402

GATE = "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"


def main(sf_dir, folder):
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"{folder}/ckpt")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    gate = spark.conf.get(GATE)
    cus, msg = load_inputs(spark, sf_dir)
    cus.repartition(200).write.parquet(f"{folder}/cus")  # many files: the slice must not inherit them
    msg.write.parquet(f"{folder}/msg")
    seen = {}
    save = DataFrameWriter.save

    def watch(self, path=None, *a, **b):
        if path == f"{folder}/target":
            plan = self._df._jdf.queryExecution().optimizedPlan().toString()
            seen["filter"] = "might_contain" in plan
            files = [f for f in self._df.inputFiles() if "customer-slice" in f]
            seen["tasks"] = len(files)
            seen["scans"] = sum(1 for line in plan.splitlines() if "Relation" in line and "visitor_app_id" in line)
        return save(self, path, *a, **b)

    DataFrameWriter.save = watch
    job.main(["--customer", f"{folder}/cus", "--messaging", f"{folder}/msg", "--target-path", f"{folder}/target",
              "--export-path", f"{folder}/export", "--as-of", "1997-06-12", "--build-ts", "2024-02-01"])
    rows, exported = spark.read.parquet(f"{folder}/target").count(), spark.read.orc(f"{folder}/export").count()
    print(f"RESULT filter={seen['filter']} gate={gate} tasks={seen['tasks']} scans={seen['scans']} rows={rows} exported={exported} left={spark.conf.get(GATE)}")


if __name__ == "__main__":
    main(*sys.argv[1:])
